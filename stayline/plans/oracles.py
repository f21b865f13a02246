"""DuckDB SQL with the same result as each registered query."""

from __future__ import annotations

# Written out here, so that an error in the package's own values shows.
TOKEN = r"[0-9]|\p{L}+|[^\s\p{L}]"
PIECE = r"[0-9]*\.[0-9]+|[0-9]+|\.|[^0-9.]+"
NUMBER_RUN = r"[0-9]+(?:[.][0-9]*)?|[.]+|[^0-9.]+"
NUMBER_WORDS = ("nan", "inf", "infinity")
MICRO = 1_000_000
CUTS, URINE_CUTS, EXCLUSION_ABOVE = (15, 35, 70, 110), (0.2, 0.5, 1.0, 1.5), 150
CATEGORIES = {98: 0, 99: 1, 100: 2, 101: 3, 102: 4, 103: 6, 104: 7, 105: 8, 106: 9, 107: 10, 108: 11, 109: 12, 110: 13, 111: 14, 112: 15, 113: 16, 114: 16}

SECONDS = "(epoch_us({0}) // 1000000)"


def sec(column: str) -> str:
    return SECONDS.format(column)


def stays(days: int) -> str:
    return f"""blocks AS (
  SELECT user_id AS hadm_id, (day(ts) - 1) // {days} AS block, min(ts) AS in_ts, max(ts) AS out_ts
  FROM events GROUP BY ALL),
admitted AS (SELECT hadm_id, min(in_ts) AS admittime FROM blocks GROUP BY ALL),
cohort AS (
  SELECT hadm_id * 100 + block AS stay_id, b.hadm_id, hadm_id % 50 AS patient_id, admittime, in_ts,
         {sec('admittime')} AS admit_s,
         CAST(floor((epoch_us(in_ts) - epoch_us(admittime)) / 60000000) AS DOUBLE) AS intime,
         (epoch_us(out_ts) - epoch_us(in_ts)) / 86400000000 AS los,
         hadm_id % 70 + 15 AS age, CAST(hadm_id % 60 + 40 AS DOUBLE) AS weight
  FROM blocks b JOIN admitted USING (hadm_id))"""


MEASURED = f"""measured AS (
  SELECT user_id AS hadm_id, event_id, event_type AS code, {sec('ts')} AS clock_s, value FROM events)"""

FIRST_EXCLUSION = f"""first_exclusion AS (
  SELECT hadm_id, min(clock_s) AS exclusion_s FROM measured
  WHERE code = 'error' AND value > {EXCLUSION_ABOVE} GROUP BY ALL)"""

TAGGED = """tagged AS (
  SELECT *, CASE code WHEN 'error' THEN 'creatinine' WHEN 'click' THEN 'platelets' WHEN 'view' THEN 'wbc'
                      WHEN 'signup' THEN 'hb' WHEN 'purchase' THEN 'urine' END AS measure
  FROM measured WHERE value IS NOT NULL)"""

PAIRS = """pairs AS (
  SELECT c.stay_id, c.intime, c.weight, t.measure, t.value, t.clock_s,
         round((t.clock_s - c.admit_s) / 60) AS minute
  FROM tagged t JOIN cohort c USING (hadm_id))"""

HORIZONS = """placed AS (
  SELECT *, CAST(floor((minute - intime - 2880) / 1440) AS INTEGER) + 1 AS horizon FROM pairs)"""


def band(value: str, cuts, labels, closed: str = "left") -> str:
    sides = [closed] * len(cuts) if isinstance(closed, str) else closed
    whens = " ".join(
        f"WHEN {value} {'<' if s == 'left' else '<='} {c!r} THEN {x}" for c, s, x in zip(cuts, sides, labels)
    )
    return f"CASE WHEN {value} IS NULL THEN NULL {whens} ELSE {labels[-1]} END"


UP, DOWN = (0, 1, 2, 3, 4), (4, 3, 2, 1, 0)


def as_text(array: str) -> str:
    return f"coalesce(array_to_string({array}, ' '), '')"


def lab_values(median: str) -> str:
    return f"""WITH {stays(3)}, {MEASURED}, {TAGGED}, {PAIRS}, {HORIZONS}
SELECT stay_id, measure, horizon, round({median}, 6) AS value
FROM placed WHERE horizon BETWEEN 1 AND 3 GROUP BY stay_id, measure, horizon"""


def labelled(excluding: bool, combine: str) -> str:
    """CTEs down to ``wide``: one row per cohort stay with all labels, missing ones null."""
    exclude = "x.exclusion_s IS NULL OR x.exclusion_s > t.clock_s"
    limited = f"(t.measure NOT IN ('creatinine', 'urine') OR {exclude})" if excluding else "true"
    urine = "CASE WHEN measure = 'urine' THEN m / weight ELSE m END"
    case = f"""CASE measure
    WHEN 'platelets' THEN {band('v', CUTS, DOWN)}
    WHEN 'urine' THEN {band('v', URINE_CUTS, DOWN)}
    ELSE {band('v', CUTS, UP)} END"""
    measures = ("creatinine", "platelets", "wbc", "hb", "urine")
    wide = ",\n  ".join(
        f"max(CASE WHEN measure = '{m}' AND horizon = {h} THEN label END) AS {m}_{h}"
        for m in measures
        for h in (1, 2, 3)
    )
    raw = ", ".join(f"max(CASE WHEN measure = 'creatinine' AND horizon = {h} THEN v END) AS v_{h}" for h in (1, 2, 3))

    def stage(h):
        own = band(f"((v_{h} - base) / nullif(base, 0))", (0.3, 1.5, 2.0, 3.0), UP)
        if combine == "skip":
            return f"greatest({own}, urine_{h}) AS AKI_{h}"
        return f"CASE WHEN ({own}) IS NULL OR urine_{h} IS NULL THEN NULL ELSE greatest({own}, urine_{h}) END AS AKI_{h}"

    stages = ", ".join(stage(h) for h in (1, 2, 3))
    kept = ", ".join(f"{m}_{h}" for m in measures for h in (1, 2, 3))
    return f"""{stays(3)}, {MEASURED}, {FIRST_EXCLUSION}, {TAGGED},
pairs AS (
  SELECT c.stay_id, c.intime, c.weight, t.measure, t.value, t.clock_s, round((t.clock_s - c.admit_s) / 60) AS minute
  FROM tagged t JOIN cohort c USING (hadm_id) LEFT JOIN first_exclusion x USING (hadm_id) WHERE {limited}),
{HORIZONS},
medians AS (
  SELECT stay_id, measure, horizon, weight, median(value) AS m FROM placed
  WHERE horizon BETWEEN 1 AND 3 GROUP BY ALL),
valued AS (SELECT *, {urine} AS v FROM medians),
banded AS (SELECT *, {case} AS label FROM valued),
base AS (
  SELECT stay_id, coalesce(
    min(value) FILTER (WHERE minute >= intime - 10080 AND minute < intime + 720),
    arg_min(value, (clock_s, value)) FILTER (WHERE minute >= intime)) AS base
  FROM pairs WHERE measure = 'creatinine' GROUP BY ALL),
picked AS (SELECT stay_id, {wide}, {raw} FROM banded GROUP BY ALL),
staged AS (SELECT p.*, {stages} FROM picked p LEFT JOIN base USING (stay_id)),
wide AS (SELECT c.stay_id, {kept}, AKI_1, AKI_2, AKI_3 FROM cohort c LEFT JOIN staged USING (stay_id))"""


LABELS = [f"{t}_{h}" for t in ("creatinine", "platelets", "wbc", "hb", "urine", "AKI") for h in (1, 2, 3)]

DEATHS = f"""deaths AS (
  SELECT c.stay_id, min(m.clock_s) AS died_s FROM cohort c JOIN measured m USING (hadm_id)
  WHERE m.code = 'error' AND m.value > {EXCLUSION_ABOVE} AND (m.clock_s - c.admit_s) / 60 >= c.intime GROUP BY ALL),
dated AS (SELECT c.*, floor((died_s - admit_s) / 60) - intime AS survived FROM cohort c LEFT JOIN deaths USING (stay_id))"""

PART_TEXT = "p_type || '|' || p_brand || '|' || p_name"


def words(text: str) -> str:
    """List of words of a text."""
    plain = f"lower(regexp_replace(regexp_replace({text}, '[-/_+]', ' ', 'g'), '[\\p{{Nd}}.,=!@#$%^&*(){{}}\\[\\];:\"\\\\|<>/?~`''-]', '', 'g'))"
    for whole, parts in (
        ("cannot", "can not"), ("gimme", "gim me"), ("lemme", "lem me"),
        ("gonna", "gon na"), ("wanna", "wan na"), ("gotta", "got ta"),
    ):
        plain = f"regexp_replace({plain}, '\\b{whole}\\b', '{parts}', 'g')"
    dropped = ", ".join(f"'{w}'" for w in NUMBER_WORDS)
    split = f"string_split_regex({plain}, '[\\s\\x{{00ab}}\\x{{00bb}}\\x{{2018}}\\x{{2019}}\\x{{201c}}\\x{{201d}}\\x{{201e}}]+')"
    return f"list_filter({split}, lambda w: length(w) > 1 AND w NOT IN ({dropped}))"


def counted(name: str, column: str) -> str:
    return f"""SELECT '{name}' AS "table", '{column}' AS "column", word, count(*) AS cnt
FROM (SELECT unnest({words(column)}) AS word FROM {name}) GROUP BY word"""


TEXT_COUNTS = "text_counts AS (" + "\nUNION ALL\n".join(
    counted(*pair)
    for pair in (("documents", "text"), ("documents", "source"), ("conversations", "role"), ("conversations", "text"))
) + ")"

LANGS = ("de", "en", "es", "fr")


def gram_list(word: str) -> str:
    marked = f"('_' || {word} || '_')"
    sizes = [
        f"list_transform(range(1, length({marked}) - {n} + 2), lambda i: substring({marked}, i, {n}))" for n in (1, 2, 3)
    ]
    return "list_concat(list_concat(" + ", ".join(sizes[:2]) + "), " + sizes[2] + ")"


def classified() -> str:
    counts = ", ".join(f"sum(CASE WHEN lang = '{x}' THEN cnt ELSE 0 END) AS c_{x}" for x in LANGS)
    totals = ", ".join(f"sum(c_{x}) AS t_{x}" for x in LANGS)
    weights = ", ".join(f"CAST(round(ln((c_{x} + 1) / (t_{x} + kinds)) * {MICRO}) AS BIGINT) AS w_{x}" for x in LANGS)
    unseen = ", ".join(f"CAST(round(ln(1 / (t_{x} + kinds)) * {MICRO}) AS BIGINT) AS u_{x}" for x in LANGS)
    scores = ", ".join(f"sum(n * coalesce(w_{x}, u_{x})) AS s_{x}" for x in LANGS)
    best = "greatest(" + ", ".join(f"s_{x}" for x in LANGS) + ")"
    spread = " + ".join(f"exp((s_{x} - {best}) / {MICRO})" for x in LANGS)
    chosen = "CASE " + " ".join(f"WHEN s_{x} = {best} THEN '{x}'" for x in LANGS) + " END"
    return f"""{TEXT_COUNTS},
lang_words AS (
  SELECT lang, word, count(*) AS cnt FROM (SELECT lang, unnest({words('text')}) AS word FROM documents)
  WHERE lang IN ('de', 'en', 'es', 'fr') GROUP BY ALL),
grams AS (
  SELECT gram, {counts} FROM (SELECT lang, cnt, unnest({gram_list('word')}) AS gram FROM lang_words) GROUP BY gram),
totals AS (SELECT count(*) AS kinds, {totals} FROM grams),
model AS (SELECT gram, {weights} FROM grams, totals),
unseen AS (SELECT {unseen} FROM totals),
cut AS (
  SELECT word, gram, count(*) AS n FROM (
    SELECT word, unnest({gram_list('word')}) AS gram FROM (SELECT DISTINCT word FROM text_counts)) GROUP BY ALL),
scores AS (SELECT word, {scores} FROM cut LEFT JOIN model USING (gram), unseen GROUP BY word),
named AS (SELECT word, {chosen} AS lang, round(1.0 / ({spread}), 3) AS prob FROM scores),
classified AS (SELECT t."table", t."column", word, lang, prob, cnt FROM text_counts t JOIN named USING (word))"""


def token_list(text: str) -> str:
    return f"regexp_extract_all({text}, '{TOKEN}')"


def rounded(text: str) -> str:
    five = "regexp_extract(p, '^[0-9]*\\.[0-9]{1,5}')"
    short = f"regexp_replace(CAST(round(CAST({five} AS DECIMAL(38, 5)), 4) AS VARCHAR), '(\\.[0-9]+?)0+$', '\\1')"
    piece = f"CASE WHEN regexp_full_match(p, '[0-9]*\\.[0-9]+') THEN {short} ELSE p END"
    return f"array_to_string(list_transform(regexp_extract_all({text}, '{PIECE}'), lambda p: {piece}), '')"


def places(text: str) -> str:
    """Digit places of a text that is already rounded."""
    whole = "(CASE WHEN instr(r, '.') > 0 THEN instr(r, '.') - 1 ELSE length(r) END)"
    number = f"list_transform(range(0, length(r)), lambda i: {whole} + 5 - i)"
    zeros = f"list_transform({token_list('r')}, lambda x: CAST(0 AS BIGINT))"
    run = f"CASE WHEN regexp_matches(r, '^[0-9]') THEN {number} ELSE {zeros} END"
    return f"flatten(list_transform(regexp_extract_all({text}, '{NUMBER_RUN}'), lambda r: {run}))"


def repeated(value: int, times: str) -> str:
    return f"list_transform(range(0, {times}), lambda x: {value})"


def linearised(table: str, keys: str, source: str, columns: list[str], codes: list[str], max_tokens: int) -> str:
    """CTEs ``units``, ``kept`` and ``rows`` for one table; column values are VARCHAR in ``source``."""
    listed = ", ".join(
        f"{{'is_code': {'true' if c in codes else 'false'}, 'name': '{c}', 'val': {c}}}" for c in columns
    )
    head = f"len({token_list(repr(table))})"
    label = "u.name"
    value = rounded("u.val")
    shape = f"""CASE WHEN u.is_code THEN {{'is_code': true, 'name': u.name, 'val': u.val,
      'tokens': CAST([] AS VARCHAR[]), 'types': CAST([] AS INTEGER[]), 'places': CAST([] AS BIGINT[])}}
    ELSE {{'is_code': false, 'name': u.name, 'val': u.val,
      'tokens': list_concat({token_list(label)}, {token_list(value)}),
      'types': list_concat({repeated(2, f'len({token_list(label)})')}, {repeated(3, f'len({token_list(value)})')}),
      'places': list_concat({places(label)}, {places(value)})}} END"""
    prefix = f"{head} + list_sum(list_transform(units[1:i], lambda x: len(x.tokens))) + 2"
    return f"""units AS (
  SELECT {keys}, list_transform(list_filter([{listed}], lambda u: u.val IS NOT NULL), lambda u: {shape}) AS units FROM {source}),
kept AS (
  SELECT {keys}, units[1:len(list_filter(range(1, len(units) + 1), lambda i: {prefix} <= {max_tokens} OR
    (units[i].is_code AND coalesce({head} + list_sum(list_transform(units[1:i - 1], lambda x: len(x.tokens))) + 2 <= {max_tokens}, true))))] AS units
  FROM units),
rows AS (
  SELECT {keys},
    list_concat({token_list(repr(table))}, flatten(list_transform(units, lambda u: u.tokens))) AS tokens,
    list_concat({repeated(1, head)}, flatten(list_transform(units, lambda u: u.types))) AS types,
    list_concat({places(repr(table))}, flatten(list_transform(units, lambda u: u.places))) AS places,
    array_to_string(list_concat(['{table}'], flatten(list_transform(
      list_filter(units, lambda u: NOT u.is_code), lambda u: [u.name, u.val]))), ' ') AS original_text,
    list_transform(list_filter(units, lambda u: u.is_code), lambda u: u.val) AS codes
  FROM kept)"""


CODED_LINES = """coded AS (
  SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(10, 1)) AS VARCHAR) AS l_quantity, l_returnflag, l_linestatus,
         CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(CAST(l_extendedprice AS DECIMAL(14, 2)) AS VARCHAR) AS l_extendedprice,
         CAST(CAST(l_discount AS DECIMAL(14, 2)) AS VARCHAR) AS l_discount, CAST(CAST(l_tax AS DECIMAL(14, 2)) AS VARCHAR) AS l_tax,
         strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
         CAST(lineitem.l_partkey AS VARCHAR) AS original_code_l_partkey, p_name AS l_partkey, p_brand, p_type
  FROM lineitem LEFT JOIN part ON lineitem.l_partkey = part.p_partkey)"""
LINE_COLUMNS = ["l_quantity", "l_returnflag", "l_linestatus", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
                "original_code_l_partkey", "l_partkey", "p_brand", "p_type"]
LINES = f"""{CODED_LINES},
{linearised('lineitem', 'l_orderkey, l_linenumber', 'coded', LINE_COLUMNS, ['original_code_l_partkey'], 128)}"""

RESERVED = "('.', 119), " + ", ".join(f"('{i}', {121 + i})" for i in range(10))


def vocabulary(source: str = "rows") -> str:
    return f"""token_counts AS (
  SELECT token, count(*) AS cnt FROM (SELECT unnest(tokens) AS token FROM {source})
  WHERE NOT regexp_full_match(token, '[0-9.]') GROUP BY ALL),
vocabulary AS (
  SELECT token, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, token) + 130 AS INTEGER) AS id FROM token_counts),
known AS (SELECT token, id FROM vocabulary UNION ALL SELECT * FROM (VALUES {RESERVED}) r(token, id))"""


def pad(values: str, first: int, last: int, length: int) -> str:
    return (
        f"list_concat(list_concat([{first}], list_transform({values}, lambda x: CAST(x AS INTEGER))), "
        f"list_concat([{last}], {repeated(0, f'greatest(0, {length} - 2 - len({values}))')}))"
    )


SEQUENCE = f"""{stays(3)},
aligned AS (
  SELECT c.stay_id, e.event_id, round(({sec('e.ts')} - c.admit_s) / 60) - c.intime AS time,
         CAST(CAST(e.value AS DECIMAL(18, 2)) AS VARCHAR) AS value, e.event_type AS original_code_event_type, e.event_type, e.props
  FROM events e JOIN cohort c ON e.user_id = c.hadm_id
  WHERE round(({sec('e.ts')} - c.admit_s) / 60) - c.intime < 2880),
{linearised('events', 'stay_id, time, event_id', 'aligned', ['value', 'original_code_event_type', 'event_type', 'props'],
            ['original_code_event_type'], 128)},
latest AS (
  SELECT * FROM rows QUALIFY row_number() OVER (PARTITION BY stay_id ORDER BY time DESC, event_id DESC) <= 256),
{vocabulary('latest')},
token_ids AS (
  SELECT stay_id, event_id, list(coalesce(id, {100}) ORDER BY pos) AS ids FROM (
    SELECT stay_id, event_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM latest)
  LEFT JOIN known USING (token) GROUP BY ALL),
packed AS (
  SELECT l.stay_id, flatten(list({pad('i.ids', 101, 102, 128)} ORDER BY time, event_id)) AS hi_input,
         flatten(list({pad('types', 5, 6, 128)} ORDER BY time, event_id)) AS hi_type,
         flatten(list({pad('places', 0, 0, 128)} ORDER BY time, event_id)) AS hi_place,
         list(time ORDER BY time, event_id) AS times,
         string_agg(original_text, '; ' ORDER BY time, event_id) AS original_texts,
         flatten(list(codes ORDER BY time, event_id)) AS codes
  FROM latest l JOIN token_ids i USING (stay_id, event_id) GROUP BY ALL)"""

ZEROS = " ".join(["0"] * 48)
ONES = as_text(repeated(1, "128"))


def code_case(mapping: dict, column: str) -> str:
    return f"CASE {column} " + " ".join(
        f"WHEN {key!r} THEN {value}" for key, value in mapping.items()
    ) + " END"


ORACLES = {
    "cohort_build": f"""WITH {stays(10)}
SELECT stay_id, hadm_id, intime AS "INTIME", los AS "LOS", age AS "AGE" FROM cohort
WHERE los >= 2 AND age BETWEEN 18 AND 80""",
    "readmission_flag": f"""WITH {stays(3)}, kept AS (SELECT * FROM cohort WHERE los >= 1)
SELECT stay_id, hadm_id, intime AS "INTIME",
  CASE WHEN row_number() OVER (PARTITION BY hadm_id ORDER BY intime DESC, stay_id) = 1 THEN 0 ELSE 1 END AS readmission
FROM kept""",
    "base_labels": f"""WITH {stays(10)}, {MEASURED}, {DEATHS}
SELECT stay_id, CAST(los > 3 AS INTEGER) AS los_3, CAST(los > 7 AS INTEGER) AS los_7,
  {', '.join(f"CAST(coalesce(survived < 2880 + {i} * 1440, false) AS INTEGER) AS mortality_{i}" for i in (1, 2, 3, 7, 14))},
  CAST(coalesce(survived < los * 1440, false) AS INTEGER) AS in_icu_mortality FROM dated""",
    "los_from_events": """WITH admitted AS (SELECT o_custkey AS stay_id, min(o_orderdate) AS a FROM orders GROUP BY ALL),
seen AS (SELECT user_id AS stay_id, ts FROM events UNION ALL SELECT o_custkey, o_orderdate FROM orders),
latest AS (SELECT stay_id, max(ts) AS last_time FROM seen GROUP BY ALL)
SELECT stay_id, last_time, (epoch_us(last_time) - epoch_us(a)) / 86400000000 AS "LOS" FROM admitted JOIN latest USING (stay_id)""",
    "first_block": f"""WITH log AS (SELECT user_id AS c, {sec('ts')} AS t, event_type IN ('view', 'click') AS inside FROM events),
entry AS (SELECT c, min(t) AS block_in FROM log WHERE inside GROUP BY ALL),
leave AS (SELECT c, min(t) AS block_out FROM log JOIN entry USING (c) WHERE NOT inside AND t >= block_in GROUP BY ALL)
SELECT c AS "CaseID", block_in, coalesce(block_out, block_in + 86400) AS block_out FROM entry LEFT JOIN leave USING (c)
WHERE coalesce(block_out, block_in + 86400) > block_in""",
    "stay_weight": f"""WITH {stays(10)}, mean AS (
  SELECT user_id * 100 + (day(ts) - 1) // 10 AS stay_id,
    avg(CASE event_type WHEN 'click' THEN value * 0.45359237 WHEN 'view' THEN value * 0.0283495231 ELSE value END) AS w
  FROM events WHERE value > 100 GROUP BY ALL),
filled AS (
  SELECT stay_id, coalesce(w, CASE hadm_id % 3 WHEN 0 THEN 80.0 WHEN 1 THEN 65.0 ELSE 72.5 END) AS w
  FROM cohort LEFT JOIN mean USING (stay_id))
SELECT stay_id, round(CAST(CASE WHEN w <= 0 THEN 72.5 ELSE w END AS DOUBLE), 6) AS weight FROM filled""",
    "weight_median_default": """WITH m AS (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS w FROM customer),
d AS (SELECT median(w) AS d FROM m)
SELECT c_custkey, round(CASE WHEN coalesce(w, d) <= 0 THEN d ELSE coalesce(w, d) END, 6) AS weight FROM m, d""",
    "normalise_source": """WITH p AS (
  SELECT c_custkey AS o_custkey, c_nationkey AS n, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey % 12 + 1 END AS month FROM customer),
s AS (SELECT l_orderkey AS o_orderkey, min(l_shipdate) AS shipped FROM lineitem GROUP BY ALL),
j AS (SELECT *, CASE WHEN n > 20 THEN 300 ELSE n END AS age, coalesce(shipped, o_orderdate) AS start_ts
      FROM orders LEFT JOIN p USING (o_custkey) LEFT JOIN s USING (o_orderkey))
SELECT o_orderkey, CAST(year(o_orderdate) - 1980 + n + 20 AS INTEGER) AS anchor_age,
  round(floor(date_diff('second', CAST(make_date(n + 1940, coalesce(month, 1), 1) AS TIMESTAMP), o_orderdate) / 86400) / 365.25, 6) AS birth_age,
  CAST(age AS BIGINT) AS text_age, CAST(least(age, 90) AS BIGINT) AS capped_age, start_ts,
  CAST(floor((epoch_us(start_ts) - epoch_us(o_orderdate)) / 60000000) AS BIGINT) AS "INTIME" FROM j""",
    "align_abs": f"""WITH {stays(3)}, t AS (
  SELECT stay_id, event_id, round(({sec('ts')} - admit_s) / 60) - intime AS tm FROM events JOIN cohort ON user_id = hadm_id)
SELECT stay_id, event_id, tm AS "TIME" FROM t WHERE tm < 2880""",
    "align_min": f"""WITH {stays(3)}, own AS (
  SELECT c.hadm_id, e.event_id, floor((epoch_us(e.ts) - epoch_us(c.in_ts)) / 60000000) + c.intime AS minute
  FROM events e JOIN cohort c ON c.stay_id = e.user_id * 100 + (day(e.ts) - 1) // 3),
t AS (SELECT stay_id, event_id, minute - intime AS tm FROM own JOIN cohort USING (hadm_id))
SELECT stay_id, event_id, tm AS "TIME" FROM t WHERE tm < 2880""",
    "align_ms": f"""WITH {stays(3)}, t AS (
  SELECT c.stay_id, e.event_id, floor((epoch_us(e.ts) - c.admit_s * 1000000) / 1000) / 60000 - c.intime AS tm
  FROM events e JOIN cohort c ON c.stay_id = e.user_id * 100 + (day(e.ts) - 1) // 3)
SELECT stay_id, event_id, tm AS "TIME" FROM t WHERE tm < 2880""",
    "code_lookup": """SELECT l_orderkey, l_linenumber, CAST(l.l_partkey AS VARCHAR) AS original_code_l_partkey,
  p_name AS l_partkey, p_brand FROM lineitem l LEFT JOIN (SELECT * FROM part WHERE p_type = 'ECONOMY') p ON l.l_partkey = p.p_partkey""",
    "ed_attach": """SELECT l_orderkey, l_linenumber, o_custkey AS hadm_id, o_orderdate AS "ED_INTIME"
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "latest_k_events": f"""WITH {stays(3)}, t AS (
  SELECT stay_id, event_id, round(({sec('ts')} - admit_s) / 60) - intime AS tm FROM events JOIN cohort ON user_id = hadm_id)
SELECT stay_id, event_id, tm AS "TIME" FROM t WHERE tm < 2880
QUALIFY row_number() OVER (PARTITION BY stay_id ORDER BY tm DESC, event_id DESC) <= 5""",
    "lab_horizon_median": lab_values("median(value)"),
    "lab_horizon_median_approx": lab_values("quantile_disc(value, 0.5)"),
    "lab_labels_wide": f"""WITH {labelled(True, 'skip')}
SELECT stay_id, {', '.join(f'coalesce({c}, -1) AS {c}' for c in LABELS)} FROM wide""",
    "label_sink": f"""WITH {labelled(True, 'skip')}
SELECT stay_id, {', '.join(f'coalesce({c}, -1) AS {c}' for c in LABELS)} FROM wide""",
    "baseline_first": f"""WITH {stays(3)}, {MEASURED}, {TAGGED}, {PAIRS}
SELECT stay_id, coalesce(
    min(value) FILTER (WHERE minute >= intime - 10080 AND minute < intime + 720),
    arg_min(value, (clock_s, value)) FILTER (WHERE minute >= intime)) AS baseline
FROM pairs WHERE measure = 'creatinine' GROUP BY stay_id HAVING baseline IS NOT NULL""",
    "aki_stage_skip": f"WITH {labelled(False, 'skip')} SELECT stay_id, AKI_1, AKI_2, AKI_3 FROM wide",
    "aki_stage_propagate": f"WITH {labelled(False, 'propagate')} SELECT stay_id, AKI_1, AKI_2, AKI_3 FROM wide",
    "row_max_modes": """WITH v AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 7 END AS a, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 4 END AS b FROM orders)
SELECT o_orderkey, greatest(a, b) AS skip, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN greatest(a, b) END AS propagate FROM v""",
    "urine_per_weight": f"""WITH {labelled(False, 'skip')}
SELECT stay_id, weight, urine_1, urine_2, urine_3 FROM cohort JOIN wide USING (stay_id)""",
    "exclude_after_first": f"""WITH {MEASURED}, {FIRST_EXCLUSION}
SELECT event_id, hadm_id, clock_s, exclusion_s FROM measured LEFT JOIN first_exclusion USING (hadm_id)
WHERE code <> 'error' AND (exclusion_s IS NULL OR exclusion_s > clock_s)""",
    "exclude_multi_patient": f"""WITH {stays(10)}, {MEASURED},
several AS (SELECT hadm_id FROM cohort GROUP BY ALL HAVING count(*) > 1),
dropped AS (SELECT hadm_id FROM several WHERE hadm_id IN (SELECT hadm_id FROM measured WHERE code = 'error' AND value > {EXCLUSION_ABOVE}))
SELECT stay_id, hadm_id, hadm_id AS patient_id FROM cohort WHERE hadm_id NOT IN (SELECT hadm_id FROM dropped)""",
    "excluded_patient_count": f"""WITH {MEASURED}, {FIRST_EXCLUSION}
SELECT count(DISTINCT hadm_id) AS patients,
  count(DISTINCT CASE WHEN exclusion_s IS NULL OR exclusion_s > clock_s THEN hadm_id END) AS patients_kept
FROM measured LEFT JOIN first_exclusion USING (hadm_id)""",
    "unit_normalise_text": """SELECT event_id,
  round(CASE event_type WHEN 'click' THEN value / 88.42 WHEN 'view' THEN value / 10.0 ELSE value END, 6) AS creatinine,
  round(CASE event_type WHEN 'error' THEN value / 1000.0 ELSE value END, 6) AS platelets,
  round(CASE event_type WHEN 'signup' THEN value / 0.6206 WHEN 'view' THEN value / 10.0 ELSE value END, 6) AS hb,
  round(CASE WHEN event_type = 'click' THEN value * 1000.0 WHEN event_type = 'view' THEN value * 1000.0
             WHEN event_type = 'error' THEN value * 1000.0 WHEN event_type = 'signup' THEN value * 1000.0
             WHEN event_type = 'purchase' THEN value * 1000.0 END, 6) AS urine FROM events""",
    "unit_normalise_id": """WITH u AS (SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 + 8645 AS unit FROM events)
SELECT event_id, round(CASE unit WHEN 8648 THEN value ELSE value / 1000 END, 6) AS value FROM u WHERE unit IN (8647, 8648) AND value IS NOT NULL""",
    "label_stats": f"""WITH {labelled(True, 'skip')}, long AS (
  UNPIVOT (SELECT {', '.join(f'CAST(coalesce({c}, -1) AS BIGINT) AS {c}' for c in LABELS)} FROM wide)
  ON {', '.join(LABELS)} INTO NAME task VALUE label)
SELECT task, label, count(*) AS n FROM long GROUP BY ALL""",
    "label_stats_wide": f"""WITH {labelled(True, 'skip')}, long AS (
  UNPIVOT (SELECT {', '.join(f'CAST(coalesce({c}, -1) AS BIGINT) AS {c}' for c in LABELS)} FROM wide)
  ON {', '.join(LABELS)} INTO NAME task VALUE label)
SELECT task, count(*) FILTER (WHERE label = -1) AS label_missing,
  {', '.join(f'count(*) FILTER (WHERE label = {i}) AS label_{i}' for i in range(5))} FROM long GROUP BY task""",
    "crosswalk_prefix": """WITH entries AS (
  SELECT p_brand AS icd10, p_type AS icd9, p_partkey AS line FROM part WHERE p_partkey % 4 <> 0),
dx AS (
  SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_brand || 'x' || p_size ELSE 'Q' || p_size END AS code,
         p_size % 5 = 0 AS is_current FROM part),
exact AS (SELECT icd10, arg_max(icd9, line) AS icd9 FROM entries GROUP BY ALL),
votes AS (
  SELECT e.icd10 AS prefix, x.icd9, count(*) AS n FROM exact e JOIN entries x ON starts_with(x.icd10, e.icd10) GROUP BY ALL),
modal AS (SELECT prefix, icd9 FROM votes QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY n DESC, icd9) = 1),
codes AS (SELECT DISTINCT code FROM dx),
by_prefix AS (
  SELECT code, m.icd9 FROM codes JOIN modal m ON starts_with(code, m.prefix)
  QUALIFY row_number() OVER (PARTITION BY code ORDER BY length(prefix) DESC) = 1)
SELECT p_partkey, code, is_current,
  CASE WHEN is_current THEN code ELSE coalesce(e.icd9, b.icd9, 'NaN') END AS converted
FROM dx LEFT JOIN exact e ON e.icd10 = code LEFT JOIN by_prefix b USING (code)""",
    "diagnosis_set": """WITH c AS (
  SELECT l_orderkey, CASE WHEN l_partkey % 18 < 14 THEN l_partkey % 18 WHEN l_partkey % 18 > 14 THEN l_partkey % 18 - 1 END AS category FROM lineitem),
s AS (SELECT l_orderkey, string_agg(CAST(category AS VARCHAR), ',' ORDER BY category) AS d FROM (
  SELECT DISTINCT l_orderkey, category FROM c WHERE category IS NOT NULL) GROUP BY ALL)
SELECT o_orderkey AS l_orderkey, coalesce(d, '') AS diagnosis FROM orders LEFT JOIN s ON o_orderkey = s.l_orderkey""",
    "path_majority": f"""WITH paths AS (SELECT {PART_TEXT} AS path, p_type || '|' || p_brand AS up, p_partkey, p_size FROM part),
own AS (SELECT path, up, min(p_size % 5) AS category FROM paths WHERE p_partkey % 4 <> 0 GROUP BY ALL),
votes AS (SELECT up, category, count(*) AS n FROM own GROUP BY ALL),
voted AS (SELECT up, category FROM votes QUALIFY row_number() OVER (PARTITION BY up ORDER BY n DESC, category) = 1)
SELECT path, coalesce(o.category, v.category) AS category
FROM (SELECT DISTINCT path, up FROM paths) p LEFT JOIN own o USING (path) LEFT JOIN voted v ON p.up = v.up""",
    "category_map": f"""SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 3 WHEN 'error' THEN 11
  WHEN 'signup' THEN 10 WHEN 'purchase' THEN 8 END AS specialty,
  {code_case(CATEGORIES, "(CAST(json_extract_string(props, '$.k') AS INTEGER) % 17 + 98)")} AS admission_group
FROM events""",
    "dpe_encode": f"""WITH raw AS (
  SELECT event_id, event_type || ' ' || CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) || ' ' ||
    CAST(CAST(round(value / 7, 6) AS DECIMAL(18, 6)) AS VARCHAR) || ' ' || props AS text FROM events),
r AS (SELECT event_id, {rounded('text')} AS text FROM raw)
SELECT event_id, text, {as_text(token_list('text'))} AS tokens, {as_text(places('text'))} AS places FROM r""",
    "event_linearise": f"""WITH {LINES}
SELECT l_orderkey, l_linenumber, {as_text('tokens')} AS tokens, {as_text('types')} AS types, {as_text('places')} AS places,
  original_text, {as_text('codes')} AS codes FROM rows""",
    "vocab_build": f"""WITH rows AS (SELECT {token_list('text')} AS tokens FROM documents), {vocabulary()}
SELECT token, cnt, id FROM vocabulary""",
    "vocab_encode": f"""WITH {LINES}, {vocabulary()},
numbered AS (SELECT row_number() OVER () AS r, * FROM rows),
ids AS (
  SELECT r, list(coalesce(id, {100}) ORDER BY pos) AS ids FROM (
    SELECT r, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM numbered) LEFT JOIN known USING (token) GROUP BY r)
SELECT l_orderkey, l_linenumber, {as_text('ids')} AS ids, {as_text('codes')} AS codes FROM numbered JOIN ids USING (r)""",
    "hourly_offsets": f"""WITH {stays(3)}, t AS (
  SELECT stay_id, event_id, round(({sec('ts')} - admit_s) / 60) - intime AS tm FROM events JOIN cohort ON user_id = hadm_id),
kept AS (
  SELECT * FROM t WHERE tm < 2880 QUALIFY row_number() OVER (PARTITION BY stay_id ORDER BY tm DESC, event_id DESC) <= 256),
l AS (SELECT stay_id, list(tm) AS times FROM kept GROUP BY ALL)
SELECT stay_id, array_to_string(list_transform(range(0, 48), lambda h: len(list_filter(times, lambda x: x < h * 60))), ' ') AS hi_start FROM l""",
    "sequence_pad": f"""WITH {SEQUENCE}
SELECT c.stay_id, CASE WHEN p.stay_id IS NULL THEN {ONES} ELSE {as_text('hi_input')} END AS hi_input,
  CASE WHEN p.stay_id IS NULL THEN {ONES} ELSE {as_text('hi_type')} END AS hi_type,
  CASE WHEN p.stay_id IS NULL THEN {ONES} ELSE {as_text('hi_place')} END AS hi_place,
  CASE WHEN p.stay_id IS NULL THEN '{ZEROS}' ELSE
    array_to_string(list_transform(range(0, 48), lambda h: len(list_filter(times, lambda x: x < h * 60))), ' ') END AS hi_start,
  CASE WHEN p.stay_id IS NULL THEN '0' ELSE {as_text('list_transform(times, lambda x: CAST(trunc(x) AS INTEGER))')} END AS time,
  coalesce(original_texts, '') AS original_texts, {as_text('codes')} AS codes
FROM cohort c LEFT JOIN packed p USING (stay_id)""",
    "word_freq": f"WITH {TEXT_COUNTS} SELECT * FROM text_counts",
    "word_count_sink": f"WITH {TEXT_COUNTS} SELECT * FROM text_counts",
    "word_freq_enriched": "WITH lineitem_text AS (SELECT l_returnflag, l_linestatus, p_name AS l_partkey, p_brand, p_type "
    "FROM lineitem LEFT JOIN part ON lineitem.l_partkey = part.p_partkey)\n"
    + "\nUNION ALL\n".join(
        counted("lineitem_text", c).replace("'lineitem_text' AS", "'lineitem' AS")
        for c in ("l_returnflag", "l_linestatus", "l_partkey", "p_brand", "p_type")
    ),
    "lang_id_words": f'WITH {classified()} SELECT "table", "column", word, lang, prob, cnt FROM classified',
    "lang_distribution": f"""WITH {classified()}
SELECT CASE WHEN GROUPING("column") = 0 THEN 'column' WHEN GROUPING("table") = 0 THEN 'table' ELSE 'overall' END AS level,
  "table", "column", lang, CAST(sum(cnt) AS BIGINT) AS cnt FROM classified
GROUP BY GROUPING SETS (("table", "column", lang), ("table", lang), (lang))""",
    "quantile_bins": """WITH e AS (
  SELECT list_distinct(quantile_cont(o_totalprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges FROM orders)
SELECT o_orderkey, 'price_' || (len(list_filter(edges, lambda x: x < o_totalprice)) + 1) AS price_bin FROM orders, e""",
    "sample_rows": """SELECT o_orderkey, o_custkey FROM orders
WHERE CAST('0x' || substr(md5('42|' || o_orderkey), 1, 8) AS BIGINT) % 10000 < 1000""",
    "optional_source_present": """SELECT o_orderkey, c_acctbal AS death_value
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "diagnosis_inner": """WITH c AS (
  SELECT l_orderkey, CASE WHEN l_partkey % 18 < 14 THEN l_partkey % 18 WHEN l_partkey % 18 > 14 THEN l_partkey % 18 - 1 END AS category
  FROM lineitem)
SELECT l_orderkey, string_agg(CAST(category AS VARCHAR), ',' ORDER BY category) AS diagnosis FROM (
  SELECT DISTINCT l_orderkey, category FROM c WHERE category IS NOT NULL) GROUP BY ALL""",
    "csv_scan": "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders",
    "csv_typed_scan": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "latin1_csv": "SELECT doc_id, text FROM documents",
    "dirty_csv": """SELECT p_partkey, p_name, CASE WHEN p_partkey % 10 <> 1 THEN p_brand END AS p_brand FROM part WHERE p_partkey % 10 <> 0""",
    "quoted_classes": "SELECT p_name AS code, p_size - 1 AS category FROM part",
    "optional_source": "SELECT o_orderkey, CAST(NULL AS TIMESTAMP) AS death_ts FROM orders",
    "cached_cohort": f"""WITH {stays(10)} SELECT stay_id, los AS "LOS" FROM cohort WHERE los >= 2""",
}

ORACLES["sequence_sink"] = ORACLES["sequence_pad"]
ORACLES["label_stats_sink"] = ORACLES["label_stats"]
ORACLES["distribution_sink"] = ORACLES["lang_distribution"]
ORACLES["word_languages_sink"] = ORACLES["lang_id_words"]
_MORE = (("bicarbonate", "click2", (22, 29)), ("sodium", "view2", (135, 145)))
_ALL = labelled(True, "skip")
_CODE = "CASE WHEN event_type IN ('click', 'view') AND event_id % 3 = 0 THEN event_type || '2' ELSE event_type END AS code"
ORACLES["lab_labels_all"] = f"""WITH {_ALL.replace("event_type AS code", _CODE)},
more_rows AS (
  SELECT c.stay_id, m.code, m.value, CAST(floor((round((m.clock_s - c.admit_s) / 60) - c.intime - 2880) / 1440) AS INTEGER) + 1 AS horizon
  FROM measured m JOIN cohort c USING (hadm_id) WHERE m.value IS NOT NULL AND m.code IN ('click2', 'view2')),
more_values AS (SELECT stay_id, code, horizon, median(value) AS v FROM more_rows WHERE horizon BETWEEN 1 AND 3 GROUP BY ALL),
more AS (SELECT stay_id, {", ".join(
    f"max(CASE WHEN code = '{c}' AND horizon = {h} THEN {band('v', cuts, (0, 1, 2))} END) AS {t}_{h}" for t, c, cuts in _MORE for h in (1, 2, 3)
)} FROM more_values GROUP BY ALL)
SELECT stay_id, {", ".join(f"coalesce({c}, -1) AS {c}" for c in [*LABELS, *(f"{t}_{h}" for t, _, _ in _MORE for h in (1, 2, 3))])}
FROM wide LEFT JOIN more USING (stay_id)"""
ORACLES["encoded_union"] = f"""WITH {stays(3)}, t AS (
  SELECT stay_id, event_id, round(({sec('ts')} - admit_s) / 60) - intime AS tm,
    CASE WHEN event_type IN ('click', 'view') THEN 'visits' ELSE 'orders' END || ' event_type ' || event_type ||
    CASE WHEN value IS NULL THEN '' ELSE ' value ' || CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) END AS original_text
  FROM events JOIN cohort ON user_id = hadm_id)
SELECT stay_id, tm AS "TIME", event_id, original_text FROM t WHERE tm < 2880
QUALIFY row_number() OVER (PARTITION BY stay_id ORDER BY tm DESC, event_id DESC) <= 256"""

for _closed in ("left", "right"):
    _wbc = ("left", "right") if _closed == "left" else ("right", "right")
    ORACLES[f"lab_bucket_{_closed}"] = f"""SELECT event_id, {band('value', CUTS, UP, _closed)} AS rising,
  {band('round(value)', CUTS, DOWN, _closed)} AS falling, {band('round(value)', (4, 12), (0, 1, 2), _wbc)} AS wbc,
  {band('value', tuple(c * 88.42 for c in (1.2, 2.0, 3.5, 5.0)), UP, _closed)} AS scaled FROM events"""
