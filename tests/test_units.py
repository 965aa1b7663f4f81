"""Hand-computed cases for the semantic traps."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from demandspark.config import DemandConfig, experiment
from demandspark.functions.moments import choose_tiles, cover
from demandspark.functions.scalar import pad_code, safe_ratio, strict_greatest, sunday_week
from demandspark.functions.stage import running_totals
from demandspark.operators import dataset as D
from demandspark.operators import features as X
from demandspark.operators import panel as P
from demandspark.operators import publish as B
from demandspark.operators import subject as S
from demandspark.operators.calendar import SHIFTED_WEEKEND, calendar_dim
from demandspark.operators import model
from demandspark.operators.model import fit_encoder, apply_encoder, regression_metrics
from demandspark.operators.quality import QualityError, assert_dense, assert_unique
from demandspark.sources.tables import merge_table, merged, read_table, refresh_range
from demandspark.sources import schemas

D0 = date(2020, 1, 1)


def day(n):
    return D0 + timedelta(days=n)


def series(spark, values, item="a", store="s", start=0):
    rows = [(item, store, day(start + i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "yj_code string, store_code string, dispensing_date date, x double")


def test_config_dates_and_feature_counts():
    cfg = DemandConfig()
    assert (cfg.end - cfg.panel_start).days == 1014
    assert cfg.train_start == cfg.feature_start - timedelta(days=1)
    assert len(X.target_columns(cfg)) == 120 + 60 + 2 + 105
    assert len(D.feature_columns(cfg)) == 287 + 60
    assert DemandConfig.from_timestamp("2023-02-28T15:30:00+00:00").end == date(2023, 3, 1)
    assert experiment("exp003")[0].windows == (180, 90, 60, 30)
    with pytest.raises(ValueError):
        DemandConfig(ops=("MEDIAN",))


def test_null_stays_null_in_clamps(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (2.0,)], "x double")
    assert [r[0] for r in df.select(strict_greatest("x", 0.0)).collect()] == [None, 0.0, 2.0]


def test_scalars(spark):
    df = spark.createDataFrame([("7", date(2023, 1, 1), 0.0), ("1234567", date(2022, 1, 1), 2.0)], "c string, d date, x double")
    got = df.select(pad_code("c"), sunday_week("d"), safe_ratio(F.lit(1.0), F.col("x"))).collect()
    assert [tuple(r) for r in got] == [("000007", 1, 0.0), ("123456", 0, 0.5)]


def test_windows_are_covered_without_overlap():
    for lengths in ([366, 181, 91, 61, 31], [8], [2, 3]):
        sizes = choose_tiles(lengths)
        for n in lengths:
            parts = cover(n, sizes)
            assert sum(s for s, _ in parts) == n
            assert [o for _, o in parts] == [sum(s for s, _ in parts[:i]) for i in range(len(parts))]


@pytest.mark.parametrize("values", [[5.0] * 40, [float(i * i % 17) for i in range(40)], [None, 1.0, None, 2.5] * 10])
def test_tiles_equal_plain_frames(spark, values):
    cfg = DemandConfig(windows=(30, 13, 6), horizon=2)
    df = series(spark, values)
    fast = X.add_stats(df, cfg, ["x"], 2).orderBy(cfg.day).collect()
    slow = X.add_stats(df, cfg, ["x"], 2, dense=False).orderBy(cfg.day).collect()
    for a, b in zip(fast, slow):
        for c in a.asDict():
            if isinstance(b[c], float):
                assert a[c] == pytest.approx(b[c], abs=1e-9), c
            else:
                assert a[c] == b[c], c
    if values[0] == 5.0:
        assert fast[-1]["x_STDDEV_30"] == 0.0


def test_replicated_standard_deviation(spark):
    """Two locations repeat the item's values: n doubles, the spread does not."""
    cfg = DemandConfig(windows=(3,), lags=(1,))
    s = spark.createDataFrame(
        [("a", day(i), float(v), float(v), v, 2.0, True) for i, v in enumerate([1, 2, 4])],
        "yj_code string, dispensing_date date, total_dose_by_yj double, total_price_by_yj double, "
        "nunique_patient_by_yj long, locations double, active boolean",
    )
    rows = X.item_stats(s, cfg, "predict").orderBy("dispensing_date").collect()
    assert rows[0]["total_dose_by_yj_STDDEV_3"] == 0.0
    assert rows[2]["total_dose_by_yj_STDDEV_3"] == pytest.approx((2 * (14 / 3) / 5) ** 0.5)
    assert rows[2]["nunique_patient_by_yj_MIN_3"] == 1


def test_calendar_priority_and_sequence(spark):
    hol = spark.createDataFrame([(date(2022, 12, 26), "h"), (date(2023, 1, 1), "元日")], "jst_date date, name string")
    cal = {r.jst_date: r for r in calendar_dim(spark, date(2022, 12, 25), 1, hol).collect()}
    assert len(cal) == 366
    assert cal[date(2022, 12, 25)].day_type == "土日"  # Sunday
    assert cal[date(2022, 12, 26)].day_type == "h"
    assert cal[date(2022, 12, 29)].day_type == "年末年始休暇"
    assert cal[date(2023, 1, 1)].day_type == "土日"
    assert cal[date(2022, 12, 27)].day_type_sequence == "100"
    assert cal[date(2022, 12, 25)].day_type_sequence == "111"
    shifted = {r.jst_date: r for r in calendar_dim(spark, date(2023, 2, 1), 1, hol, SHIFTED_WEEKEND).collect()}
    assert shifted[date(2023, 2, 2)].is_holiday and not shifted[date(2023, 2, 4)].is_holiday  # Thursday, Saturday


def test_uniqueness_compares_typed_keys_and_nulls(spark):
    assert_unique(spark.createDataFrame([("a", "bc"), ("ab", "c")], "x string, y string"), ["x", "y"])
    for rows in ([("a", "b"), ("a", "b")], [("a", None)]):
        with pytest.raises(QualityError):
            assert_unique(spark.createDataFrame(rows, "x string, y string"), ["x", "y"])
    with pytest.raises(QualityError):
        assert_dense(series(spark, [1.0]).union(series(spark, [1.0], start=2)), ["yj_code", "store_code"], "dispensing_date")


def test_diff_lag_is_horizon_minus_one_rows(spark):
    cfg = DemandConfig(horizon=3)
    df = series(spark, [1.0, 2.0, 4.0, 8.0]).selectExpr("*", "x as total_dose_by_yj_store", "x as total_dose_by_yj")
    got = [r.diff_total_dose_by_yj for r in P.diff_panel(df, cfg).orderBy("dispensing_date").collect()]
    assert got == [None, None, 3.0, 6.0]


def test_minmax_roundtrip_and_constant_series(spark):
    cfg = DemandConfig(end=day(200), horizon=7, train_days=100, valid_days=7, test_days=7)
    wave = series(spark, [float(i % 9) for i in range(190)], "a")
    flat = series(spark, [3.0] * 190, "b")
    panel = wave.union(flat).selectExpr("*", "x as total_dose_by_yj_store", "x as total_dose_by_yj")
    scaler = P.minmax_scaler(panel, cfg)
    scaled = P.scaled_panel(panel, scaler, cfg)
    assert scaled.filter("yj_code = 'b' and scaled_total_dose_by_yj <> 0").count() == 0
    preds = scaled.withColumn("predicted_total_dose", F.col("scaled_total_dose_by_yj_store"))
    back = B.inverse_minmax(preds.select(*cfg.keys, "predicted_total_dose"), scaler, cfg)
    joined = back.join(panel, cfg.keys).filter(F.abs(F.col("predicted_total_dose") - F.col("x")) > 1e-9)
    assert joined.count() == 0


def test_inverse_diff_bases_and_log_roundtrip(spark):
    cfg = DemandConfig()
    base = series(spark, [2.0, 5.0]).selectExpr("*", "x as total_dose_by_yj_store", "x * 10 as lag_total_dose_by_yj_store")
    preds = base.selectExpr("yj_code", "store_code", "dispensing_date", "-3.0D as predicted_total_dose")
    now = B.inverse_diff(preds, base, cfg).orderBy("dispensing_date").collect()
    lag = B.inverse_diff(preds, base, cfg, "lag_total_dose_by_yj_store").orderBy("dispensing_date").collect()
    assert [r.predicted_total_dose for r in now] == [0.0, 2.0]
    assert [r.predicted_total_dose for r in lag] == [17.0, 47.0]
    logs = base.selectExpr(*cfg.keys, "log1p(x) as predicted_total_dose")
    got = [r.predicted_total_dose for r in B.inverse_log(logs, cfg).orderBy("dispensing_date").collect()]
    assert got == pytest.approx([2.0, 5.0])


def test_sampling_drops_unflagged_rows_except_scaled(spark):
    cfg = DemandConfig(sample_rate=2)
    rows = [("a", "s", day(i), y, f) for i, (y, f) in enumerate(
        [(0.0, "train"), (0.0, "train"), (1.0, "train"), (0.0, None), (1.0, None), (0.0, "test"), (-1.0, "train"), (None, "test")]
    )]
    df = spark.createDataFrame(
        rows, "yj_code string, store_code string, dispensing_date date, total_dose_monthly double, split_flag string"
    )
    kept = sorted(r.dispensing_date for r in D.train_sample(df, cfg, "log").collect())
    assert kept == [day(1), day(2), day(5), day(7)]
    kept = sorted(r.dispensing_date for r in D.train_sample(df, cfg, "scaled").collect())
    assert kept == [day(1), day(2), day(4), day(5)]


def test_running_totals_share_ties_and_put_nulls_first(spark):
    df = spark.createDataFrame([("g", None, None), ("g", 1.0, 2.0), ("g", 3.0, 3.0), ("h", 1.0, 1.0)], "k string, v double, w double")
    got = running_totals(df, ["k"], "v", {"cum": F.col("w")}).collect()
    assert {(r.k, r.v): r.cum for r in got} == {("g", None): None, ("g", 1.0): 2.0, ("g", 3.0): 5.0, ("h", 1.0): 1.0}


def test_merge_updates_listed_columns_only(spark, tmp_path):
    t = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, v int, note string")
    s = spark.createDataFrame([("b", 9, "new"), ("c", 3, "new")], "k string, v int, note string")
    got = sorted(tuple(r) for r in merged(t, s, ["k"], ["v"]).collect())
    assert got == [("a", 1, "old"), ("b", 9, "old"), ("c", 3, "new")]
    rows = spark.createDataFrame([("a", "s", D0, 1.0)], schemas.MODEL_PREDICTION)
    path = str(tmp_path / "t")
    for _ in range(2):
        merge_table(rows, path, schemas.MODEL_PREDICTION, ["yj_code", "store_code", "dispensing_date"], ["predicted_total_dose"], "dispensing_date")
    assert read_table(spark, path, schemas.MODEL_PREDICTION).count() == 1
    with pytest.raises(QualityError):
        merge_table(rows.union(rows), path, schemas.MODEL_PREDICTION, ["yj_code", "store_code", "dispensing_date"], ["predicted_total_dose"], "dispensing_date")


def test_refresh_removes_days_without_new_rows(spark, tmp_path):
    path, keys = str(tmp_path / "r"), ["yj_code", "store_code", "dispensing_date"]
    full = series(spark, [1.0] * 70)
    refresh_range(full, path, "dispensing_date", day(0), day(70), keys)
    fresh = series(spark, [2.0], start=40)
    for _ in range(2):
        refresh_range(fresh, path, "dispensing_date", day(31), day(70), keys)
    got = read_table(spark, path, full.schema).orderBy("dispensing_date").collect()
    assert [r.x for r in got] == [1.0] * 31 + [2.0]


@pytest.mark.parametrize("lookup,broadcast", [(1000, 1000), (0, 1000), (0, 0), (2, 2), (0, 2)])
def test_encoder_codes_sorted_with_replacement(spark, monkeypatch, lookup, broadcast):
    """By maps, by broadcast tables, by one exploded join, or some columns each way."""
    rows = [("k1", "pear", 1.0, "train"), ("k2", "apple", 2.0, "train"), ("k3", "pear", 1.0, "valid"),
            ("k4", "apple", 3.0, "valid"), ("k5", None, None, "test"), ("k6", "zoo", 9.0, "test")]
    df = spark.createDataFrame(rows, "key string, c string, n double, split_flag string")
    monkeypatch.setattr(model, "LOOKUP_ROWS", lookup)
    monkeypatch.setattr(model, "BROADCAST_ROWS", broadcast)
    coded = apply_encoder(df, fit_encoder(df, ["c", "n"]), ["c", "n"])
    assert coded.columns == [*df.columns, "c_code", "n_code"]
    got = {r.key: (r.c_code, r.n_code) for r in coded.collect()}
    # small dictionaries do not shuffle the rows
    assert ("Exchange hashpartitioning" in coded._jdf.queryExecution().executedPlan().toString()) == (broadcast < 3)  # the larger one has three entries
    # texts: apple 0, other 1, pear 2; numbers: -20000 is 0, 1.0 is 1
    assert got == {"k1": (2, 1), "k2": (0, 0), "k3": (2, 1), "k4": (0, 0), "k5": (1, 0), "k6": (1, 0)}


def test_metrics_with_added_back_lag(spark):
    df = spark.createDataFrame([(1.0, 2.0, 10.0), (3.0, 3.0, 20.0)], "y double, p double, lag double")
    r = regression_metrics(df, "y", "p", "m", "lag").first()
    assert (r.rmse, r.mae) == (pytest.approx(0.5 ** 0.5), 0.5)
    assert r.r2 == pytest.approx(1 - 1 / 72)


def test_prescribers_repeat_and_padding(spark):
    cfg = DemandConfig(end=day(1000), train_days=300)
    d0 = cfg.prescriber_start
    rows = [("a", "7", d0, "D2"), ("a", "7", d0, "D1"), ("a", "7", d0, "D2"), ("a", "7", cfg.prescriber_end, "D9"), ("b", "7", d0, None)]
    rx = spark.createDataFrame(rows, "yj_code string, store_code string, dispensing_date date, doctor_code string")
    got = {(r.yj_code, r.store_code): r.doctors for r in X.doctor_feature(rx, cfg).collect()}
    assert got == {("a", "000007"): "D1 D2 D2", ("b", "000007"): None}
    raw = X.doctor_feature(rx, cfg, pad=False, form="counted").filter("yj_code = 'a'").first()
    assert (raw.store_code, raw.doctors) == ("7", "D1*1 D2*2")


def test_interval_mode_scales_support_by_same_day_rows(spark):
    cfg = DemandConfig(end=day(400), train_days=200, min_support=1, interval_days=100)
    rows = [("a", "000001", day(300 + 10 * i), p, 0, 1.0, 1.0) for i in range(3) for p in ("p", "q")][:5]
    rx = spark.createDataFrame(
        rows, "yj_code string, store_code string, dispensing_date date, patient_no string, hi_kaisu long, total_dose double, drug_price double"
    )
    pairs = rx.select("yj_code", "store_code").distinct()
    got = {r.dispensing_date: r.cnt for r in S.interval_mode(rx, pairs, cfg.with_(min_support=0)).collect()}
    # day 310 gives two gaps; day 320 has one visit row and sees both of them
    assert got[day(320)] == 2 and day(310) not in got
    assert got[day(321)] == 3
    plain = S.interval_mode(rx, pairs, cfg.with_(scale_support=False, min_support=2)).collect()
    assert {r.dispensing_date for r in plain} and min(r.dispensing_date for r in plain) == day(321)


def test_prescriber_digest_parts_pairs_as_the_text_does(spark):
    """Order does not matter, counts do; NULL codes count for nothing; the key has a bounded size."""
    cfg = DemandConfig(end=day(900))
    days = cfg.prescriber_start
    sets = {"1": "ab", "2": "ba", "3": "aab", "4": "abb", "5": "", "6": "cd" * 400, "7": "dc" * 400, "8": "cd" * 399 + "c"}
    rows = [(f"y{k}", s, days, d) for k in (1, 2) for s, codes in sets.items() for d in (codes or [None])]
    rx = spark.createDataFrame(rows, "yj_code string, store_code string, dispensing_date date, doctor_code string").repartition(3)
    forms = {f: {(r.yj_code, r.store_code): r.doctors for r in X.doctor_feature(rx, cfg, form=f).collect()} for f in ("text", "digest")}
    assert set(forms["text"]) == set(forms["digest"]) and len(forms["text"]) == 16
    pairs = sorted(forms["text"])
    assert all((forms["text"][a] == forms["text"][b]) == (forms["digest"][a] == forms["digest"][b]) for a in pairs for b in pairs)
    assert all((forms["text"][p] is None) == (forms["digest"][p] is None) for p in pairs)
    assert max(len(v) for v in forms["digest"].values() if v) < 60


def test_ordered_prescribers_sort_and_part_pairs_as_the_text_does(spark):
    """Counts of one to four digits, codes that begin like others, texts that end early; the size is bounded by the codes."""
    cfg = DemandConfig(end=day(900))
    rng = random.Random(5)
    codes = ["D1", "D10", "D2", "a", "é", "other", "!", "~"]
    sets = [{}, {"other": 1}, {"other": 2}, {"D1": 999, "D10": 1}, {"D1": 1000}, {"D1": 1000, "D10": 2}, {"D1": 9, "D2": 1}, {"D1": 10, "D2": 1}]
    sets += [{c: rng.choice([1, 1, 2, 9, 10, 11, 99, 100, 3000]) for c in rng.sample(codes, rng.randint(1, 4))} for _ in range(300)]
    rows = [(f"y{i % 7}", str(i), d, n) for i, s in enumerate(sets) for d, n in (s.items() or [(None, 3)])]
    counts = spark.createDataFrame(rows, "yj_code string, store_code string, doctor_code string, n long").repartition(3)
    forms = {f: {r.store_code: r.doctors for r in X.doctor_texts(counts, cfg, f).collect()} for f in ("text", "ordered")}
    text, key = ([forms[f][str(i)] for i in range(len(sets))] for f in ("text", "ordered"))
    assert [t is None for t in text] == [k is None for k in key] == [not s for s in sets]
    texts, keys = ([v.encode() for v in x if v is not None] for x in (text, key))
    assert len(set(texts)) > 150 and len(set(texts)) == len(set(zip(texts, keys))) == len(set(keys))
    assert sorted(range(len(texts)), key=lambda i: texts[i]) == sorted(range(len(keys)), key=lambda i: keys[i])
    assert [t < b"other" for t in texts] == [k < b"other" for k in keys] and [t == b"other" for t in texts] == [k == b"other" for k in keys]
    assert max(map(len, texts)) > 10_000 and max(map(len, keys)) < 50


@pytest.mark.parametrize("code, plain", [("D1", True), ("é~!", True), (None, True), ("D 1", False), ("D1 ", False), ("D1\n", False), ("", False)])
def test_codes_of_other_than_one_word_are_not_plain(spark, code, plain):
    counts = spark.createDataFrame([("a", "1", "D2", 1), ("a", "1", code, 1)], "yj_code string, store_code string, doctor_code string, n long")
    assert X.plain_codes(counts) == plain
    assert X.plain_codes(counts.where("false"))


def test_spells_are_events_and_expand_to_the_days_asked_for(spark):
    cfg = DemandConfig(end=day(500), train_days=60, windows=(30,), tail_days=60)
    d0 = cfg.panel_start
    events = [(0, 7, 2.0), (9, 0, 1.0), (10, 14, 0.0), (75, 7, 3.0)]
    rows = [("p", "y", "1", d0 + timedelta(days=40 + k), n, x, 1.0, "d") for k, n, x in events] + [("q", "y", "1", d0 + timedelta(days=3), 7, 1.0, 1.0, "d")]
    rx = spark.createDataFrame(rows, "patient_no string, yj_code string, store_code string, dispensing_date date, hi_kaisu long, total_dose double, drug_price double, doctor_code string")
    pairs = spark.createDataFrame([("y", "000001")], "yj_code string, store_code string")
    spells = S.subject_spells(rx, pairs, cfg)
    assert spells.count() <= len(rows) + 2
    dense = S.subject_history(rx, pairs, cfg)
    assert dense.groupBy("patient_no", "dispensing_date").count().filter("count > 1").isEmpty()
    assert dense.count() == spells.select(F.sum(F.datediff("valid_to", "valid_from") + 1)).first()[0] > 100
    a, b = d0 + timedelta(days=45), d0 + timedelta(days=60)
    part = S.expand_spells(spells, cfg, a, b)
    want = dense.filter(F.col("dispensing_date").between(F.lit(a), F.lit(b)))
    key = lambda r: tuple(map(str, r))
    assert part.columns == want.columns and sorted(map(key, part.collect())) == sorted(map(key, want.collect()))
    assert part.filter("patient_no = 'p'").count() == 16
