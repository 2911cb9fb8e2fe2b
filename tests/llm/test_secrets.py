import hashlib
import re
import time

from demandkit.llm import secrets as S

KEY = "AKIA" + "Q7XW2MZP4LK9TR5B"


def brute(text):
    text = text or ""
    assign = [("assign", m.start(), m.end()) for m in re.finditer(
        r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
        r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[1]) >= 12]
    access = [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    hexes = [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    kinds = ("assign", "access", "hex")
    spans = sorted(assign + access + hexes, key=lambda x: (x[1], kinds.index(x[0])))
    return len(assign), len(access), len(hexes), hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


TEXTS = [None, "", "é password = 'abcdefghijkl' x", "PassWD:short secret: abcdefghijklmnop", "api_key=\"A1b2C3d4E5f6\"",
         "token=password=abcdefghijkl", f"id {KEY} and AKIASHORT", "AKIA" * 9, "deadbeef" * 4 + "g" + "0" * 16,
         "ſecret=abcdefghijklmnop Kelvin apiKey:abcdefghijklmnop", "secret : secret : aaaaaaaaaaaaaaaa", "x" * 200_000 + "token=" + "y" * 50]


def test_base_spans_match_plain_patterns(make_docs, fixture_rows):
    rows = [*fixture_rows, *((10_000 + i, t) for i, t in enumerate(TEXTS))]
    text = {r[0]: r[1] for r in rows}
    got = S.scan(make_docs(rows, extra=True)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == brute(text[r.doc_id]), text[r.doc_id]


def test_constants_reach_sensitive_names():
    text = 'base_value = "q8Zr-11kd-Ww92xx"\nname = "just a plain label"\nconfig.db_credential = base_value\n'
    spans = [text[s:e] for s, _, e in S.lexed_spans(text)]
    assert spans == ["q8Zr-11kd-Ww92xx"]


def test_joined_literals_and_placeholders():
    text = "signing_credential := \"aB3dEf\" + 'GH1jk2Lm'\nclient_credential: changeme\nauth_credential: ${VAULT}\n"
    found = S.lexed_spans(text)
    assert [text[s:e] for s, _, e in found] == ["aB3dEf\" + 'GH1jk2Lm"]


def test_prose_has_no_spans(make_docs):
    assert S.lexed_spans("Note: the token: was = lost in time, as a password often is: gone.") == []
    assert S.scan(make_docs([])).collect() == []


def test_null_and_repeated_rows(make_docs):
    got = S.scan(make_docs([(1, "token=abcdefghijkl"), (1, "token=abcdefghijkl"), (None, None)])).collect()
    assert sorted(r.n_assign for r in got) == [0, 1, 1]


def test_redact_keeps_rows_and_columns(make_docs):
    docs = make_docs([(1, "a token=abcdefghijkl b"), (2, None), (3, "clean")], extra=True)
    out = {r.doc_id: r for r in S.redact(docs).collect()}
    assert out[1].text == "a [secret] b" and out[2].text is None and out[3].text == "clean" and out[1].key == "x-key"


def lexed(text):
    return [text[s:e] for s, _, e in S.lexed_spans(text)]


def test_literals_of_any_length_and_escapes():
    long = "aB3dEf9h" * 250
    for text in (f'private_key = "{long}"', f"private_key: {long}\n", f"private_key = '{long}'", f'"auth_pwd": "{long}", "x": 1'):
        assert lexed(text) == [long]
    escaped = 'q8Zr-11kd\\nWw92xx\\"kd03\\\\' + long
    assert lexed(f'signing_credential = "{escaped}"; other = "b"') == [escaped]
    assert S._redacted(f'private_key = "{long}"', "[secret]") == 'private_key = "[secret]"'
    assert lexed("a" * 100 + "_credential = 'q8Zr-11kd-Ww92xx'") == ["q8Zr-11kd-Ww92xx"]


def test_quoted_subscripts_are_part_of_the_name():
    assert lexed('os.environ["DB_PASSWORD"] = "q8Zr-11kd-Ww92xx"') == ["q8Zr-11kd-Ww92xx"]
    assert lexed("cfg['db'][0]['auth_pwd']='q8Zr-11kd-Ww92xx'") == ["q8Zr-11kd-Ww92xx"]
    assert lexed('os.environ["' + "X_" * 50 + 'PASSWORD"] = "q8Zr-11kd-Ww92xx"') == ["q8Zr-11kd-Ww92xx"]
    assert lexed('labels["title"] = "q8Zr-11kd-Ww92xx"') == []


def test_long_texts_take_linear_time():
    units = ("x", "-", "0", "a=", 'a="', "a='", 'a="\\', "a[1]", "[1]", 'a["k"]', '["k"]', "a['k'][0]", "a[b]", "a[b[", "a[b]=",  "a[", 'a["', "a['\"", 'a="x"+"y"', " ", "a ", "a= ", '"', '"a', "a['a[\"")
    for unit in units:
        start = time.perf_counter()
        S.lexed_spans(unit * (200_000 // len(unit)))
        assert time.perf_counter() - start < 10, unit


def test_closed_subscripts_by_the_thousand():
    for marks in ("[1]" * 10_000, '["k0"]' * 10_000, "['a'][1]" * 10_000, "[ab c]" * 10_000):
        for text in (f"see a{marks}", f"see a{marks}.", f"a{marks} password_x{marks}"):
            start = time.perf_counter()
            assert lexed(text) == []
            assert time.perf_counter() - start < 1
    assert lexed(f"cfg{'[1]' * 10_000}['auth_pwd'] = 'q8Zr-11kd-Ww92xx'") == ["q8Zr-11kd-Ww92xx"]
