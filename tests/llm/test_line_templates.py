import collections
import hashlib

from demandkit.llm import line_templates as L


def brute(rows):
    """Templates leaf by leaf, one line and one template at a time."""
    docs = collections.Counter()
    for r in dict.fromkeys((r[0], r[1] or "") for r in rows):
        docs.update({b" ".join(L.fields(x)) for x in (r[1] or "").encode().split(b"\n") if x.split()})
    leaves, gone = collections.defaultdict(list), set()
    for c in sorted(docs):
        parts = c.split(b" ")
        leaves[len(parts), tuple(parts[:L.LEADING])].append(c)
    for lines in leaves.values():
        found = []
        for c in lines:
            parts, best = c.split(b" "), None
            for t in found:
                equal = sum(a == b for a, b in zip(t[0], parts, strict=True))
                if equal >= L.SIMILARITY * len(parts) and (best is None or equal > best[0]):
                    best = equal, t
            if best is None:
                found.append([parts, [c]])
            else:
                t = best[1]
                t[0] = [a if a == b else L.FIELD for a, b in zip(t[0], parts, strict=True)]
                t[1].append(c)
        gone.update(c for t in found if sum(docs[c] for c in t[1]) >= L.LEAST_DOCS for c in t[1])
    out = []
    for r in rows:
        lines = (r[1] or "").encode().split(b"\n")
        kept = [x for x in lines if not x.split() or b" ".join(L.fields(x)) not in gone]
        out.append((r[0], len(lines), len(lines) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect())


def test_matches_brute_force(make_docs, fixture_rows):
    assert got(L.clean(make_docs(fixture_rows, parts=5))) == brute(fixture_rows)


def test_variable_fields_and_edge_cases(make_docs):
    rows = [(i, f"Order {i} shipped to customer {c} by our fast courier today\nunique words of text {c}x {i}")
            for i, c in enumerate(["anna", "bob", "carl", "dora"])]
    rows += [(10, None), (11, ""), (12, "\n\n \n"), (13, "a " * 50_000), (14, "same\nsame\nsame"), (15, "Same")]
    docs = make_docs(rows, extra=True)
    assert got(L.clean(docs)) == brute(rows)
    first = next(r for r in L.clean(docs).collect() if r.doc_id == 0)
    assert b"courier" not in bytes(first.text)


def test_repeated_rows_null_ids_and_empty_table(make_docs):
    rows = [(1, "one line here\nleft"), (1, "one line here\nleft"), (None, "one line here\nright"), (2, "other")]
    out = L.clean(make_docs(rows)).collect()
    assert len(out) == 4 and sorted(r.n_dropped for r in out) == [0, 0, 0, 0]  # two documents hold the line
    rows.append((3, "one line here"))
    assert sorted(r.n_dropped for r in L.clean(make_docs(rows)).collect()) == [0, 1, 1, 1, 1]
    assert L.clean(make_docs([])).collect() == []


def by_documents(rows):
    """Row numbers whose lines are dropped: templates as in :func:`brute`, each
    with the set of rows that hold one of its lines."""
    docs = collections.defaultdict(set)
    for r in rows:
        n = (r[0], r[1] or "")
        for x in (r[1] or "").encode().split(b"\n"):
            if x.split():
                docs[b" ".join(L.fields(x))].add(n)
    leaves, gone = collections.defaultdict(list), set()
    for c in sorted(docs):
        leaves[len(c.split(b" ")), tuple(c.split(b" ")[:L.LEADING])].append(c)
    for lines in leaves.values():
        for group in L.templates([(c, []) for c in lines]):
            if len(set().union(*(docs[lines[i]] for i in group))) >= L.LEAST_DOCS:
                gone.update(lines[i] for i in group)
    out = []
    for r in rows:
        lines = (r[1] or "").encode().split(b"\n")
        kept = [x for x in lines if not x.split() or b" ".join(L.fields(x)) not in gone]
        out.append((r[0], len(lines), len(lines) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return sorted(out)


def test_a_template_counts_documents_not_lines(make_docs, fixture_rows):
    one = (1, "mix the red paint\nmix the red glue\nmix the red sand\nmix the red dust")
    two = (2, "boil an egg soft\nboil an egg hard")
    three = [(2 + i, f"turn the page {w}") for i, w in enumerate(("over", "back", "now"), 1)]
    rows = [one, two, (6, "boil an egg twice\nlast"), *three]
    want = {1: 0, 2: 0, 6: 0, 3: 1, 4: 1, 5: 1}
    assert {r.doc_id: r.n_dropped for r in L.clean(make_docs(rows)).collect()} == want
    rows = [(i, t) for i, t, *_ in fixture_rows] + [(10**6 + i, t) for i, t in rows]
    assert got(L.clean(make_docs(rows, parts=5))) == by_documents(rows)
