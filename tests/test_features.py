import datetime as dt

import numpy as np
import pandas as pd

from demandkit.operators.features import LAG_COLS, demand_features, lag_rolling

BASE = dt.date(2024, 1, 1)


def _daily(spark, values, gaps=()):
    dates, d = [], BASE
    for i in range(len(values)):
        dates.append(d)
        d = d + dt.timedelta(days=2 if i in gaps else 1)
    return spark.createDataFrame([(d, float(v), 1) for d, v in zip(dates, values)],
                                 "date date, daily_total_demand double, daily_rows int"), dates


def test_lags_and_rolling_match_pandas(spark):
    rng = np.random.default_rng(1)
    vals = rng.integers(0, 100, 80)
    df, dates = _daily(spark, vals, gaps=(10, 40))
    got = lag_rolling(df).toPandas().sort_values("date").reset_index(drop=True)
    s = pd.Series(vals, dtype=float)
    exp = {"lag_1": s.shift(1), "lag_7": s.shift(7), "lag_14": s.shift(14), "lag_30": s.shift(30),
           "rolling_7_mean": s.rolling(7).mean(), "rolling_14_mean": s.rolling(14).mean(),
           "rolling_30_mean": s.rolling(30).mean(), "rolling_7_std": s.rolling(7).std()}
    for c, e in exp.items():
        assert np.allclose(got[c].astype(float).to_numpy(), e.to_numpy(), equal_nan=True), c


def test_fewer_than_seven_days(spark):
    df, _ = _daily(spark, [5, 6, 7])
    got = lag_rolling(df).toPandas()
    assert got["rolling_7_mean"].isna().all() and got["lag_1"].notna().sum() == 2


def test_days_mode_counts_missing_dates_as_zero(spark):
    df, _ = _daily(spark, [1, 2, 3, 4, 5, 6, 7, 8], gaps=(3,))
    got = lag_rolling(df, mode="days", lags=(1,), windows=(7,), std_windows=()).toPandas().sort_values("date")
    # The day after the gap sees a zero-demand day as lag 1.
    assert got["lag_1"].tolist()[4] == 0.0
    assert np.isclose(got["rolling_7_mean"].tolist()[-1], (3 + 4 + 0 + 5 + 6 + 7 + 8) / 7)


def test_exclude_current(spark):
    df, _ = _daily(spark, list(range(1, 11)))
    got = lag_rolling(df, lags=(1,), windows=(3,), std_windows=(), exclude_current=True).toPandas()
    got = got.sort_values("date")
    assert got["rolling_3_mean"].tolist()[3] == 2.0  # mean of 1, 2, 3


def test_partitioned_series(spark):
    rows = [(g, BASE + dt.timedelta(days=i), float(i + 10 * k), 1) for k, g in enumerate("ab") for i in range(9)]
    df = spark.createDataFrame(rows, "g string, date date, daily_total_demand double, daily_rows int")
    got = lag_rolling(df, partition_by=["g"], lags=(1,), windows=(7,), std_windows=()).toPandas()
    b = got[got.g == "b"].sort_values("date")
    assert b["lag_1"].isna().sum() == 1 and b["rolling_7_mean"].notna().sum() == 3


def test_flagship_drops_warmup(spark, small_dir):
    from demandkit.sources.tables import sales_view
    out = demand_features(sales_view(spark, small_dir))
    assert out.count() > 0
    for c in LAG_COLS:
        assert out.where(out[c].isNull()).count() == 0
