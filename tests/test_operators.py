"""Edge cases by hand, and brute force on small skewed data."""

import random
import re
import shutil
import statistics

import pyarrow.parquet as pq
import pytest
from checks import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stayline.functions import timeframe, tokens, values
from stayline.functions.tokens import round_decimals
from stayline.functions.words import words_of
from stayline.operators import cohort, diagnosis, encode, events, labels, labs, language, quantiles, words
from stayline.sources import readers, writers


def one(spark, column, **cols):
    """Value of an expression over one row."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]).select(column).collect()[0][0]


def test_bands_own_their_edges(spark):
    at = [1.19, 1.2, 2.0, 5.0, 5.01, None, float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(at)], "i int, v double")
    bands = {side: labs.task_bands("creatinine", side).label("v").alias(side) for side in ("left", "right")}
    found = [(r["left"], r["right"]) for r in df.orderBy("i").select(*bands.values()).collect()]
    assert found == [(0, 0), (1, 0), (2, 1), (4, 3), (4, 4), (None, None), (None, None)]


def test_middle_wbc_band_is_closed_on_both_ends_when_left_closed(spark):
    df = spark.createDataFrame([(3.9,), (4.0,), (12.0,), (12.1,)], "v double")
    pick = lambda side: [r[0] for r in df.select(labs.task_bands("wbc", side).label("v")).collect()]
    assert pick("left") == [0, 1, 1, 2] and pick("right") == [0, 0, 1, 2]


def test_row_max_modes(spark):
    df = spark.createDataFrame([(1, 3), (None, 3), (1, None), (None, None)], "a int, b int")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(values.row_max(a, b)).collect()] == [3, 3, 1, None]
    assert [r[0] for r in df.select(values.row_max(a, b, missing="propagate")).collect()] == [3, None, None, None]


def test_relative_change_to_zero_is_null(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 0.0), (2.0, None)], "v double, b double")
    assert [r[0] for r in df.select(values.relative_change(F.col("v"), F.col("b"))).collect()] == [1.0, None, None]


def test_units_of_time(spark):
    assert one(spark, timeframe.offset_minutes(F.col("x"), "ms"), x=90_000) == 1.5
    with pytest.raises(ValueError):
        timeframe.offset_minutes(F.lit(1), "hours")
    early, late = F.lit("2150-01-01 00:00:30").cast("timestamp"), F.lit("2150-01-01 00:00:00").cast("timestamp")
    assert one(spark, timeframe.whole_minutes_between(early, late)) == -1
    assert one(spark, timeframe.minutes_between(late, early)) == 1.0


def test_readmission_one_two_three_stays_and_ties(spark):
    df = spark.createDataFrame(
        [(1, 1, 5.0), (2, 2, 1.0), (3, 2, 2.0), (4, 3, 1.0), (5, 3, 9.0), (6, 3, 9.0), (7, None, 1.0), (8, 4, None)],
        "stay_id long, hadm_id long, INTIME double",
    )
    found = dict(rows(cohort.flag_readmission(df), "stay_id", "readmission"))
    assert found == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0, 6: 1, 7: 1, 8: 0}


def test_first_block(spark):
    log = spark.createDataFrame(
        [("a", 5, False), ("a", 10, True), ("a", 12, True), ("a", 10, False), ("b", 1, True), ("c", 1, False)],
        "CaseID string, Offset long, inside boolean",
    )
    assert rows(cohort.first_block(log, F.col("inside"))) == [("a", 10, 10), ("b", 1, None)]


def test_exact_median_small_groups(spark):
    data = [("one", [7.0]), ("two", [1.0, 2.0]), ("three", [3.0, 1.0, 2.0]), ("four", [1.0, 2.0, 3.0, 10.0]), ("ties", [2.0] * 5 + [9.0])]
    df = spark.createDataFrame([(k, v) for k, vs in data for v in vs] + [("one", None)], "k string, v double")
    found = dict(rows(quantiles.exact_median(df, ["k"], "v")))
    assert found == {k: statistics.median(vs) for k, vs in data}
    approximate = dict(rows(quantiles.approximate_median(df, ["k"], "v")))
    assert approximate["four"] == 2.0 and found["four"] == 2.5


def test_exact_median_of_a_hot_group_by_ranges(spark):
    rng = random.Random(7)
    data = [("hot", round(rng.expovariate(0.01), 3)) for _ in range(20_001)]
    data += [(f"k{i % 50}", round(rng.gauss(0, 5), 2)) for i in range(5_000)]
    df = spark.createDataFrame(data, "k string, v double").repartition(8)
    groups = {}
    for k, v in data:
        groups.setdefault(k, []).append(v)
    want = {k: pytest.approx(statistics.median(vs)) for k, vs in groups.items()}
    assert dict(rows(quantiles.exact_median(df, ["k"], "v"))) == want
    assert rows(quantiles.exact_median(df, [], "v")) == [(pytest.approx(statistics.median(v for _, v in data)),)]


def test_quantiles_of_a_hot_group_by_ranges(spark):
    rng = random.Random(11)
    data = [round(rng.gauss(0, 100), 2) for _ in range(6_000)] + [5.0] * 500
    df = spark.createDataFrame([(v,) for v in data], "v double").repartition(6)
    points = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = list(quantiles.exact_quantiles(df, [], "v", points).collect()[0][0])
    data.sort()
    for point, got in zip(points, found):
        at = (len(data) - 1) * point
        low, high = data[int(at)], data[min(int(at) + 1, len(data) - 1)]
        assert got == pytest.approx(low + (high - low) * (at - int(at)))
    assert found[0] == data[0] and found[-1] == data[-1]


def test_quantiles_of_repeated_values_and_null_keys(spark):
    """Between equal neighbours the quantile is that very value, in small and large groups alike."""
    values = [30.81] * 4 + [31.2] * 4
    data = [("small", None, v) for v in values] + [("large", None, v) for v in values * 4000]
    data += [(None, 1.0, v) for v in (30.81, 30.81, 30.81)] + [(None, 2.0, 5.0)]
    df = spark.createDataFrame(data, "k string, w double, v double")
    found = {(r["k"], r["w"]): list(r["quantiles"]) for r in quantiles.exact_quantiles(df, ["k", "w"], "v", [0.1, 0.25, 0.9]).collect()}
    assert found[("small", None)] == found[("large", None)] == [30.81, 30.81, 31.2]
    assert found[(None, 1.0)] == [30.81] * 3 and found[(None, 2.0)] == [5.0] * 3
    small, large = (quantiles.exact_median(df.where(f"k = '{k}'"), ["k"], "v") for k in ("small", "large"))
    shape = [re.sub(r"Location:[^]]*\]|[#0-9]+L?|small|large", "", x._jdf.queryExecution().executedPlan().toString()) for x in (small, large)]
    assert shape[0] == shape[1]


def test_group_summary_lowest_and_first(spark):
    df = spark.createDataFrame([("a", 3, 5.0), ("a", 1, 9.0), ("a", 1, 8.0), ("a", 2, 1.0)], "k string, t int, v double")
    summary = quantiles.group_summary(df, ["k"], "v", at="t")
    assert rows(summary, "k", "median", "lowest", "first") == [("a", 6.5, 1.0, 8.0)]


def skewed_admission(spark, n_events=3000, n_stays=12, seed=3):
    """One admission with a third of all events; stays a few days apart."""
    rng = random.Random(seed)
    stays, found = [], []
    for hadm in range(1, 6):
        for s in range(n_stays if hadm == 1 else 2):
            stays.append((hadm * 100 + s, hadm, 0, float(s * 4320 + rng.randrange(600))))
    for i in range(n_events):
        hadm = 1 if i % 3 == 0 else rng.randrange(2, 6)
        found.append((hadm, i, rng.choice("abc"), rng.randrange(0, 60 * 86_400), round(rng.random() * 9, 1)))
    return (
        spark.createDataFrame(found, "hadm_id long, event_id long, code string, clock_s long, value double"),
        spark.createDataFrame(stays, "stay_id long, hadm_id long, admit_s long, INTIME double"),
        found,
        stays,
    )


def half_up(x):
    import math

    return math.floor(x + 0.5)


def test_horizon_medians_against_brute_force(spark):
    ev, st, found, stays = skewed_admission(spark)
    want = {}
    for stay, hadm, admit, intime in stays:
        for h, _, code, sec, v in found:
            minute = half_up((sec - admit) / 60)
            horizon = (minute - intime - 2880) // 1440 + 1
            if h == hadm and 1 <= horizon <= 3:
                want.setdefault((stay, code, int(horizon)), []).append(v)
    tagged = labs.tag_measures(ev, {c: [c] for c in "abc"})
    got = labs.horizon_medians(tagged, st, "hadm_id", labs.LabRules())
    assert {tuple(r[:3]): r[3] for r in rows(got)} == {k: pytest.approx(statistics.median(v)) for k, v in want.items()}


def test_baseline_against_brute_force(spark):
    ev, st, found, stays = skewed_admission(spark, n_events=90)
    want = {}
    for stay, hadm, admit, intime in stays:
        own = [(sec, v, half_up((sec - admit) / 60)) for h, _, _, sec, v in found if h == hadm]
        window = [v for _, v, m in own if intime - 10080 <= m < intime + 720]
        later = sorted((sec, v) for sec, v, m in own if m >= intime)
        if window or later:
            want[stay] = min(window) if window else later[0][1]
    assert dict(rows(labs.baseline(ev, st, "hadm_id"))) == want


def test_horizon_edges(spark):
    st = spark.createDataFrame([(1, 1, 0, 0.0)], "stay_id long, hadm_id long, admit_s long, INTIME double")
    minutes = [2879, 2880, 2880 + 1439, 2880 + 1440, 2880 + 4319, 2880 + 4320]
    ev = spark.createDataFrame([(1, "a", m * 60, float(m)) for m in minutes], "hadm_id long, measure string, clock_s long, value double")
    assert rows(labs.horizon_medians(ev, st, "hadm_id", labs.LabRules()), "horizon", "value") == [
        (1, (2880 + 4319) / 2), (2, 4320.0), (3, 7199.0)
    ]


def test_exclusion_before_at_after(spark):
    df = spark.createDataFrame([(1, 10, 11), (2, 10, 10), (3, 10, 9), (4, 10, None)], "i int, clock_s long, exclusion_s long")
    assert rows(labs.before_exclusion(df), "i") == [(1,), (4,)]


@pytest.mark.parametrize("k", [1, 4, 40])
def test_latest_events_of_a_hot_admission(spark, k):
    ev, st, found, stays = skewed_admission(spark)
    want = []
    for stay, hadm, admit, intime in stays:
        own = [(half_up((sec - admit) / 60) - intime, i) for h, i, _, sec, _ in found if h == hadm]
        want += [(stay, i, t) for t, i in sorted((x for x in own if x[0] < 2880), reverse=True)[:k]]
    got = events.latest_clock_events(ev, st, "hadm_id", 48, k, ["event_id"])
    assert sorted(map(tuple, got.select("stay_id", "event_id", "TIME").collect())) == sorted(want)


def test_crosswalk(spark):
    walk = spark.createDataFrame(
        [("A1", "x", 0), ("A1", "y", 1), ("B", "p", 2), ("B1", "q", 3), ("B2", "q", 4), ("C", "n", 5), ("C1", "m", 6)],
        "icd10cm string, icd9cm string, line int",
    )
    codes = spark.createDataFrame([("A1",), ("A19",), ("B9",), ("C9",), ("D",), ("",), (None,)], "code string")
    found = dict(rows(diagnosis.crosswalk_codes(codes, walk, order="line")))
    # A19: entries from A1 tie between x and y; B9: q twice; C9: m and n tie
    assert found == {"A1": "y", "A19": "x", "B9": "q", "C9": "m", "D": "NaN", "": "NaN"}
    literal = dict(rows(diagnosis.crosswalk_codes(codes, walk, order="line", prefix_fallback=False)))
    assert literal["A19"] == "NaN" and literal["A1"] == "y"


def test_deep_paths(spark):
    known = spark.createDataFrame(
        [("a|b|c|d|e", 1), ("a|b|c|f", 2), ("a|b|g|h|i", 2), ("a|b", 9), ("z|y|x|w|v", 4), ("z|y|x", 5)], "path string, category int"
    )
    asked = spark.createDataFrame([("a|b|c|new",), ("a|b|other",), ("a|q",), ("z|y|new",), ("z|y|x|w|n",), ("a|b",)], "path string")
    found = dict(rows(diagnosis.path_categories(asked, known)))
    # c: children 1 and 2 tie -> 1; a|b has its own class; y: child x has its own 5
    assert found == {"a|b|c|new": 1, "a|b|other": 9, "a|q": None, "z|y|new": 5, "z|y|x|w|n": 4, "a|b": 9}


def test_specialty_and_unknown_category(spark):
    df = spark.createDataFrame([("Niet operatief Gastro-intestinaal", False), ("Trauma - x", True)], "v string, s boolean")
    key = diagnosis.specialty_key(F.col("v"), F.col("s"))
    assert [r[0] for r in df.select(diagnosis.literal_category(key, diagnosis.SPECIALTY_CATEGORY)).collect()] == [5, 8]
    with pytest.raises(Exception, match="no category for"):
        df.select(diagnosis.literal_category(F.col("v"), diagnosis.SPECIALTY_CATEGORY)).collect()


NUMBERS = [
    ("12.5", "12.5", [7, 6, 5, 4]), ("123", "123", [8, 7, 6]), ("0.05", "0.05", [6, 5, 4, 3]), (".5", "0.5", [6, 5, 4]),
    ("1.2.3", "1.20.3", [6, 5, 4, 3, 0, 6]), ("..", "..", [0, 0]), ("0.123456", "0.1235", [6, 5, 4, 3, 2, 1]),
    ("ab 12.50 mg", "ab 12.5 mg", [0, 7, 6, 5, 4, 0]), ("5.", "5.", [6, 5]), ("", "", []), ("x_1/2", "x_1/2", [0, 0, 6, 0, 6]),
]


def test_number_tokens(spark):
    df = spark.createDataFrame([(i, n[0]) for i, n in enumerate(NUMBERS)], "i int, raw string")
    shaped = df.withColumn("text", tokens.round_decimals("raw")).orderBy("i")
    found = shaped.select("text", tokens.digit_places("text").alias("p"), tokens.token_list("text").alias("t")).collect()
    assert [(r["text"], list(r["p"])) for r in found] == [(n[1], n[2]) for n in NUMBERS]
    for (raw, _, places), r in zip(NUMBERS, found):
        assert tokens.constant_unit(raw) == (list(r["t"]), places)


def test_linearise_stops_at_first_overflow(spark):
    df = spark.createDataFrame(
        [(1, 0.0, "short", "a b c d e f g h", "tiny", "C1", "C2"), (2, 0.0, None, "x", "y", None, "C2")],
        "stay_id int, TIME double, a string, b string, c string, code1 string, code2 string",
    )
    got = encode.linearise(df, "t1", ["a", "code1", "b", "c", "code2"], ["code1", "code2"], 10)
    found = {r["stay_id"]: r for r in got.collect()}
    # t 1 a short = 4 tokens; b adds 9: over 8, so c and code2 are lost too
    assert found[1]["original_text"] == "t1 a short" and list(found[1]["codes"]) == ["C1"]
    assert list(found[1]["types"]) == [1, 1, 2, 3] and list(found[1]["places"]) == [0, 6, 0, 0]
    assert found[2]["original_text"] == "t1 b x c y" and list(found[2]["codes"]) == ["C2"]


def test_linearise_takes_any_column_name(spark):
    df = spark.createDataFrame([(1, 0.0, "x")], "stay_id int, TIME double, `it's a.b` string")
    assert rows(encode.linearise(df, "o'clock", ["it's a.b"], [], 30), "original_text") == [("o'clock it's a.b x",)]


def test_sequences(spark):
    cohort_df = spark.createDataFrame([(1,), (2,)], "stay_id int")
    df = spark.createDataFrame([(1, t, f"v{t}") for t in (-5.5, 0.0, 59.0, 60.0, 61.0)], "stay_id int, TIME double, v string")
    rows_ = encode.linearise(df, "t", ["v"], [], 12)
    vocabulary = encode.build_vocabulary(rows_, size=1)
    packed = encode.stay_sequences(encode.encode_tokens(rows_, vocabulary), cohort_df, 4, 12, 3)
    found = {r["stay_id"]: r for r in packed.collect()}
    assert list(found[1]["time"]) == [0, 59, 60, 61] and list(found[1]["hi_start"]) == [0, 2, 4]
    first = found[1]["hi_input"][0]
    # one vocabulary entry: "v" is the most frequent token; "t" is unknown; 0 is a fixed digit id
    assert list(first) == [101, 100, 131, 131, 121, 119, 121, 102, 0, 0, 0, 0]
    assert list(found[2]["hi_start"]) == [0, 0, 0] and list(found[2]["time"]) == [0]
    assert [list(e) for e in found[2]["hi_place"]] == [[1] * 12] and list(found[2]["codes"]) == []


def test_every_token_gets_an_id(spark):
    words_ = [f"t{i}" for i in range(40_000)] + ["t1"] * 3 + ["t2", "."]
    df = spark.createDataFrame([(1, words_), (2, ["t1", "7"]), (2, ["t1", "7"]), (3, []), (4, None)], "k int, tokens array<string>")
    vocabulary = encode.build_vocabulary(df)
    ids = dict(rows(vocabulary, "token", "id"))
    ranked = sorted({w for w in words_ if w != "."}, key=lambda w: (-(words_.count(w) if w in ("t1", "t2") else 1), w))
    assert len(ids) == 40_000 and [ids[w] for w in ranked] == list(range(131, 131 + 40_000))
    found = sorted((r["k"], list(r["ids"])) for r in encode.encode_tokens(df, vocabulary).collect())
    assert found[0][1][:2] == [ids["t0"], ids["t1"]] and found[0][1][-1] == 119 and 100 not in found[0][1]
    assert found[1:] == [(2, [131, 128]), (2, [131, 128]), (3, []), (4, [])]
    assert "Python" not in encode.encode_tokens(df, vocabulary)._jdf.queryExecution().toString().replace("pythonEvals", "")


def test_head_tokens_take_no_join(spark):
    """A vocabulary within the head is looked up in place; one beyond it explodes only what the head lacks."""
    df = spark.createDataFrame([(i, [f"w{i % 7}", "5", f"w{i % 3}"]) for i in range(50)], "k int, tokens array<string>")
    vocabulary = encode.build_vocabulary(df)
    ids = dict(rows(vocabulary, "token", "id")) | {"5": 126}
    whole = encode.encode_tokens(df, vocabulary)
    plan = whole._jdf.queryExecution().toString()
    assert "Join" not in plan and "Generate" not in plan and "Exchange" not in plan
    want = sorted((i, [ids[t] for t in [f"w{i % 7}", "5", f"w{i % 3}"]]) for i in range(50))
    assert sorted((r["k"], list(r["ids"])) for r in whole.collect()) == want
    for tokens, share, size in ((2, 1.0, 1 << 20), (100, 0.5, 1 << 20), (100, 1.0, 40)):
        head = encode.TokenHead(vocabulary, tokens, share, size)
        assert len(head.kept) <= 11 + tokens and (tokens == 100 or not head.whole)
        assert dict(df.select(F.explode("tokens").alias("t")).distinct().select("t", head.id(F.col("t"))).collect()).items() <= (
            {t: i if t in head.kept else None for t, i in ids.items()}.items()
        )


def test_encoding_with_a_short_head(spark, monkeypatch):
    df = spark.createDataFrame([(i, [f"w{i % 70}", ".", f"w{i % 3}", "none"] * (i % 4)) for i in range(200)], "k int, tokens array<string>")
    vocabulary = encode.build_vocabulary(df).where("token <> 'none'")
    whole = sorted((r["k"], list(r["ids"])) for r in encode.encode_tokens(df, vocabulary).collect())
    full = encode.TokenHead
    monkeypatch.setattr(encode, "TokenHead", lambda v: full(v, 3))
    assert sorted((r["k"], list(r["ids"])) for r in encode.encode_tokens(df, vocabulary).collect()) == whole
    assert sum(100 in ids for _, ids in whole) == 150


def test_values_are_encoded_like_their_tokens(spark, monkeypatch):
    """Vocabulary and ids of printed values, frequent or not, are those of the rows' tokens, and no list of tokens is made."""
    df = spark.sql(
        """SELECT id AS k, CAST(id % 7 - 3 AS DECIMAL(12, 6)) / 7 AS d, CAST(id * 1000003 % 90001 - 500 AS BIGINT) AS n,
           CAST(id % 3 * 1e-7 AS DECIMAL(20, 10)) AS tiny, CASE WHEN id % 5 > 0 THEN date_add(DATE '2024-02-28', CAST(id * 40 AS INT)) END AS t,
           CASE WHEN id = 3 THEN DATE '+12024-02-08' WHEN id % 2 = 0 THEN DATE '1999-12-31' END AS far,
           CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Straße 12.50001 \u00e9\u0301 a-b' WHEN 3 THEN concat('w', id, ' x', id % 9) WHEN 4 THEN '-7' ELSE repeat('long ', 30) END AS s,
           concat('c', id % 4) AS code, CAST(id % 2 AS STRING) AS last FROM range(400)"""
    )
    columns = ["d", "n", "tiny", "code", "t", "far", "s", "last"]
    for room in (500, 60, 30):
        plain = encode.linearise(df, "tab_1.5", columns, ["code"], room, ("k",))
        units = encode.linearise(df, "tab_1.5", columns, ["code"], room, ("k",), units=True)
        assert rows(units, "k", "tokens", "types", "places", "original_text", "codes") == rows(plain, "k", "tokens", "types", "places", "original_text", "codes")
        kept, listed = units.select("k", "units", "codes").localCheckpoint(), plain.localCheckpoint()
        vocabulary = encode.build_vocabulary(listed)
        assert rows(encode.build_vocabulary(kept)) == rows(vocabulary)
        known = vocabulary.where("token NOT IN ('x', '-', 'last')").localCheckpoint()
        for words_ in (vocabulary, known, vocabulary.where("token = '-'"), vocabulary.limit(0)):
            want = rows(encode.encode_tokens(listed, words_), "k", "ids")
            assert rows(encode.encode_tokens(kept, words_), "k", "ids") == want
            assert rows(encode.encode_tokens(kept, words_, separator=" "), "k", "ids") == [(k, " ".join(map(str, ids))) for k, ids in want]
    plan = encode.encode_tokens(kept, vocabulary, separator=" ")._jdf.queryExecution().toString()
    assert "Join" not in plan and "Generate" not in plan and "Exchange" not in plan and "Python" not in plan.replace("pythonEvals", "")
    want, full = rows(encode.encode_tokens(listed, vocabulary), "k", "ids"), encode.TokenHead
    monkeypatch.setattr(encode, "TokenHead", lambda v: full(v, 3))
    monkeypatch.setattr(encode, "HEAD_VALUES", 5)
    assert rows(encode.encode_tokens(kept, vocabulary), "k", "ids") == want
    assert rows(encode.encode_tokens(kept, vocabulary, separator=","), "k", "ids") == [(k, ",".join(map(str, ids))) for k, ids in want]


def test_typed_values_are_encoded_like_their_text(spark):
    """Numbers and dates give what their printed text gives, without a pattern over them."""
    values = spark.sql(
        """SELECT CAST(v AS DECIMAL(12, 6)) AS d, CAST(v AS DECIMAL(9, 2)) AS m, CAST(v AS DECIMAL(20, 0)) AS w, CAST(v AS BIGINT) AS i,
           CAST(v AS INT) AS j, date_add(DATE '2024-02-28', CAST(v * 300 AS INT)) AS t, CAST(NULL AS DATE) AS n
           FROM VALUES (0), (1.5), (-1.5), (12345.678949), (-0.00005), (0.00004), (99999.99995), (10), (-7), (100.10), (NULL), (2400) AS x(v)"""
    )
    typed = encode.linearise(values, "t", values.columns, [], 500, keep=())
    texts = values.select(*[F.col(c).cast("string").alias(c) for c in values.columns])
    names = ["tokens", "types", "places", "original_text"]
    assert rows(typed, *names) == rows(encode.linearise(texts, "t", values.columns, [], 500, keep=()), *names)
    assert "RLIKE" not in typed._jdf.queryExecution().toString() and "regexp" not in typed._jdf.queryExecution().toString()
    far = spark.sql("SELECT DATE '+12024-02-08' AS t, DATE '-0044-03-15' AS u")
    printed = far.select(*[F.col(c).cast("string").alias(c) for c in far.columns])
    assert rows(encode.linearise(far, "t", ["t", "u"], keep=()), *names) == rows(encode.linearise(printed, "t", ["t", "u"], keep=()), *names)


def test_a_busy_stay_above_the_group_limit(spark):
    df = spark.range(30_000).selectExpr("id % 2 AS stay_id", "cast(id % 7000 AS double) AS TIME", "id AS e")
    limited = events.latest_events(df, 1200, ["e"])
    plain = df.selectExpr("*", "row_number() OVER (PARTITION BY stay_id ORDER BY TIME DESC, e DESC) AS r").where("r <= 1200")
    assert rows(limited, "stay_id", "e") == rows(plain, "stay_id", "e")


def test_one_stay_is_read_from_one_file(spark, tmp_path):
    df = spark.range(40_000).selectExpr("id * 3 AS stay_id", "array_repeat(cast(rand(1) AS string), 20) AS hi_input")
    path, before = str(tmp_path / "s"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        writers.write_sequences(df.repartition(8), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(spark.read.parquet(path).inputFiles()) > 3 and spark.read.parquet(path).count() == 40_000
    for stay in (0, 77 * 3, 39_999 * 3):
        found = writers.read_stay(spark, path, stay)
        assert len(found.inputFiles()) == 1 and rows(found, "stay_id") == [(stay,)]
    assert writers.read_stay(spark, path, 76).count() == 0 and writers.read_stay(spark, path, -5).count() == 0


def test_sequence_files_are_made_once_and_read_in_small_groups(spark, tmp_path):
    """A reader's batch ends with a row group, so padded stays never meet by thousands; the arrays are worked out once."""
    calls = spark.sparkContext.accumulator(0)

    def padded(stay: int) -> list[int]:
        calls.add(1)
        return [stay] * 128

    df = spark.range(2000).select((F.col("id") * 7 - 900).alias("stay_id"))
    df = df.withColumn("hi_input", F.udf(padded, "array<int>")("stay_id"))
    path = str(tmp_path / "s")
    writers.write_sequences(df.repartition(3), path)
    assert calls.value == 2000
    files = sorted((tmp_path / "s").glob("part-*.parquet"))
    found = [pq.ParquetFile(f) for f in files]
    groups = [f.metadata.row_group(k).num_rows for f in found for k in range(f.metadata.num_row_groups)]
    assert sum(groups) == 2000 and max(groups) <= writers.GROUP_STAYS
    ranges = sorted((ids[0], ids[-1], ids == sorted(ids)) for f in found if (ids := f.read(["stay_id"])["stay_id"].to_pylist()))
    assert len(ranges) == 4 and all(r[2] for r in ranges) and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert min(f.metadata.num_rows for f in found) > 300
    back = rows(spark.read.parquet(path).select("stay_id", F.size("hi_input"), F.col("hi_input")[127]))
    assert sorted(back) == [(i * 7 - 900, 128, i * 7 - 900) for i in range(2000)]
    few = spark.createDataFrame([("b", [1]), ("a", [2])], "stay_id string, hi_input array<int>")
    writers.write_sequences(few, path)
    assert rows(writers.read_stay(spark, path, "a"), "stay_id") == [("a",)] and spark.read.parquet(path).count() == 2
    writers.write_sequences(few.limit(0), path)
    assert spark.read.parquet(path).count() == 0


def test_codes_reach_the_scan(spark, tmp_path):
    for name, expr, codes in (("text", "cast(id AS string)", [5, "7"]), ("whole", "cast(id AS int)", ["5", 7])):
        spark.range(100).selectExpr(f"{expr} AS code", "1.0D AS value").write.parquet(str(tmp_path / name))
        tagged = labs.tag_measures(spark.read.parquet(str(tmp_path / name)), {"hb": codes})
        plan = tagged._jdf.queryExecution().executedPlan().toString()
        assert "In(code, [5,7])" in plan.split("PushedFilters")[1] and tagged.count() == 2


def test_decimals_are_rounded_once(spark):
    texts = ["0.00004999999999999999", "2.00005", "1.23454999999", "x 0.99995 y", "123456789012345678901234567890.00005"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(round_decimals("t")).collect()] == ["0.0", "2.0001", "1.2345", "x 1.0 y", "123456789012345678901234567890.0001"]


def test_encoding_has_no_python_and_truncates_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 0.0, "x")], "stay_id int, TIME double, v string")
    rows_ = encode.linearise(df, "t", ["v"], [], 12)
    plan = events.latest_events(rows_, 3, ["original_text"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("pythonEvals", "") and "WindowGroupLimit" in plan
    partial = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in partial


def test_words(spark):
    texts = ["Nan inf 1e5 a-b/c_d+e Ünïcode don't", None, "IV-fluid 0.9% NaCl (500ml)", "cannot infinity “quoted”"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r[0] for r in df.select(words_of(F.col("text"))).collect()]
    assert found == [["ünïcode", "dont"], None, ["iv", "fluid", "nacl", "ml"], ["can", "not", "quoted"]]
    counts = words.word_counts(df.withColumn("n", F.lit(1)), "t", words.text_columns(df))
    assert ("t", "text", "iv", 1) in rows(counts)


def test_language_counts_do_not_depend_on_partitions(spark):
    text = spark.createDataFrame([("the house is the home", "en"), ("das haus ist das heim", "de")], "text string, lang string")
    model = language.train(text, "text", "lang", ["de", "en"])
    counts = words.word_counts(text, "t", ["text"])
    one_part = rows(language.classify_counts(counts, model, ["de", "en"]))
    many = language.train(text.repartition(7), "text", "lang", ["de", "en"])
    assert one_part == rows(language.classify_counts(counts.repartition(5), many, ["de", "en"]))
    assert {r[0]: r[4] for r in one_part}["haus"] == "de"
    assert all(0 < r[5] <= 1 for r in one_part)


def test_fill_and_stats(spark):
    df = spark.createDataFrame([(1, 2, None), (2, None, 1)], "stay_id long, los_7 int, hb_1 int")
    stats = rows(labels.label_stats(df))
    assert stats == [("hb_1", -1, 1), ("hb_1", 1, 1), ("los_7", -1, 1), ("los_7", 2, 1)]
    assert rows(labels.fill_missing(df)) == [(1, 2, -1), (2, -1, 1)]


def test_quantile_bins_merge_repeated_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 1, 2, 3, 4, 5]] + [(None,)], "v double")
    found = sorted({(r["v"], r["bin"]) for r in quantiles.quantile_bins(df, "v", 4).collect()}, key=str)
    assert found == [(1.0, 1), (2.0, 2), (3.0, 2), (4.0, 3), (5.0, 3), (None, None)]


def test_quantile_bins_of_few_values(spark):
    """At most as many bins as distinct values."""
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 3.0, 3.0, None)], "v double")
    found = sorted((r["v"], r["bin"]) for r in quantiles.quantile_bins(df, "v", 10).where("v IS NOT NULL").collect())
    assert [b for _, b in found] == [1, 1, 2, 2, 2]


def test_readers(spark, tmp_path):
    dirty = tmp_path / "dirty.csv"
    dirty.write_bytes('"a","b"\n"1",x"\ny\n1,2,3\n"Caf\xe9",\n'.encode("latin-1").replace(b"\xe9", "é".encode()))
    assert rows(readers.read_dirty_csv(spark, str(dirty), ["a", "b"]), "a", "b") == [("1", "x"), ("Café", None), ("y", None)]
    classes = tmp_path / "classes.csv"
    classes.write_text("'ICD-9-CM CODE','CCS LVL 1'\n'0010 ','1'\n'0020','bad'\n")
    assert rows(readers.read_classes(spark, str(classes))) == [("0010", 0), ("0020", None)]
    latin = tmp_path / "latin.csv"
    latin.write_bytes("a,b\nblå,1\n".encode("latin-1"))
    assert rows(readers.read_raw(spark, str(latin), encoding="ISO-8859-1")) == [("blå", "1")]
    assert readers.read_raw(spark, str(latin), row_limit=0).count() == 0
    assert readers.read_optional(spark, str(tmp_path / "none.csv"), "x int").count() == 0
    with pytest.raises(ValueError):
        readers.read_raw(spark, str(latin), "avro")


def test_sample_is_the_same_on_every_partitioning(spark):
    df = spark.range(20_000)
    first = readers.sampled(df, 0.1, "id")
    assert rows(first) == rows(readers.sampled(df.repartition(13), 0.1, "id"))
    assert 1_800 < first.count() < 2_200


def test_cache_depends_on_settings(spark, tmp_path):
    made = []

    def build():
        made.append(1)
        return spark.range(3)

    for settings in ({"a": 1}, {"a": 1}, {"a": 2}):
        assert writers.cached(spark, str(tmp_path), "x", settings, build, reuse=True).count() == 3
    assert len(made) == 2
    writers.cached(spark, str(tmp_path), "x", {"a": 1}, build)
    assert len(made) == 3


def test_cache_depends_on_inputs(spark, tmp_path):
    """A changed input is built again, and so is what a broken run left."""
    made, source, folder = [], tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.csv").write_text("1")

    def get():
        return writers.cached(spark, folder, "x", {}, lambda: made.append(1) or spark.range(3), True, [str(source), str(tmp_path / "none")])

    assert get().count() == 3 and get().count() == 3 and len(made) == 1
    (source / "b.csv").write_text("2")
    assert get().count() == 3 and len(made) == 2
    (source / "b.csv").write_text("longer")
    get(), get()
    assert len(made) == 3
    shutil.rmtree(next((tmp_path / "out").iterdir()) / "_manifest")
    assert get().count() == 3 and len(made) == 4


def test_ranges_are_narrowed_until_small(spark, monkeypatch):
    """The values that meet in one window stay few, whatever the size of a group."""
    largest, whole = [], quantiles._narrowed

    def narrowed(*args):
        found = whole(*args)
        largest.append(found[2])
        return found

    monkeypatch.setattr(quantiles, "_narrowed", narrowed)
    monkeypatch.setattr(quantiles, "LARGEST", 200)
    for n in (1_000, 100_000):
        largest.clear()
        values_ = spark.range(n).selectExpr("cast(pow(id % 997, 3) + id % 7919 / 7919D AS double) AS v", "IF(id % 3 = 0, NULL, id % 3) AS g", "id")
        got = quantiles.exact_quantiles(values_, ["g"], "v", [0.0, 0.1, 0.5, 1.0]).collect()
        assert largest and largest[-1] <= 200
        want = values_.groupBy("g").agg(F.expr("percentile(v, array(0.0, 0.1, 0.5, 1.0))").alias("q")).collect()
        assert {r["g"]: [round(x, 6) for x in r["quantiles"]] for r in got} == {r["g"]: [round(x, 6) for x in r["q"]] for r in want}


def test_skipped_and_padded_lines_are_counted(spark, tmp_path):
    lines = ["a,b,c"] + ["1,2,3", '"4",5,"6"', "7,8", "9", "1,2,3,4", "1,2,3,4,5", "x,,z"] * 30
    (tmp_path / "one.csv").write_text("\n".join(lines))
    (tmp_path / "two.csv").write_text("\n".join(lines[:3]))
    seen = Observation("lines")
    found = readers.read_dirty_csv(spark, str(tmp_path), ["a", "b", "c"], seen)
    assert found.select("a", "b", "c").count() == 5 * 30 + 2
    assert seen.get == {"lines": 7 * 30 + 2, "skipped": 60, "padded": 60}


def test_unknown_unit_is_an_error(spark):
    df = spark.createDataFrame([(1, 5)], "stay_id int, at int")
    with pytest.raises(ValueError):
        events.align(df, df, "hours", "at", 48)
