"""Events as token sequences, and stays as bounded, padded sequences of events."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.functions.tokens import (
    characters,
    column,
    constant_unit,
    digit_places,
    kind_of,
    round_decimals,
    rounded_decimal,
    text_literal,
    token_list,
    tokens_sql,
    typed_places,
)
from stayline.operators.events import latest_events
from stayline.session import saved

# Type ids.
TYPE_TABLE, TYPE_COLUMN, TYPE_VALUE, TYPE_CLS, TYPE_SEP = 1, 2, 3, 5, 6
PLACE_OTHER = 0
# Token ids with a meaning; other tokens follow from FIRST_ID by frequency.
PAD_ID, UNKNOWN_ID, CLS_ID, SEP_ID, POINT_ID = 0, 100, 101, 102, 119
DIGIT_IDS = {str(d): 121 + d for d in range(10)}
FIRST_ID = 131
RESERVED = {".": POINT_ID, **DIGIT_IDS}

#: The head of a vocabulary that rows look up in place: at most so many tokens and bytes, and enough for this share of occurrences.
HEAD_TOKENS = 20_000
HEAD_BYTES = 1 << 20
HEAD_SHARE = 0.999
#: Values looked up as a whole: at most so many, their longest length, and the longest one of a number.
HEAD_VALUES, VALUE_LENGTH, SHORT_NUMBER = 2000, 100, 4


def linearise(
    events: DataFrame,
    table: str,
    columns: list[str],
    codes: list[str] | None = None,
    max_tokens: int = 128,
    keep: tuple[str, ...] = ("stay_id", "TIME"),
    units: bool = False,
) -> DataFrame:
    """One event row as tokens, type ids, digit places, plain text and codes.

    The table name comes first, then ``column value`` for each non-null column in the given
    order.  The first column that would exceed ``max_tokens`` (less two for the wrapping tokens)
    ends the row: later columns, and later codes, are left out.

    With ``units`` a column of that name holds the printed values themselves (see ``Units``), from which vocabulary and ids are
    made without a list of tokens for every row.
    """
    codes = codes or []
    head_tokens, head_places = constant_unit(table)
    shown = [c for c in columns if c not in codes]

    # one projection per step, so that nothing is worked out twice; numbers and dates follow from their
    # types, without a pattern, and there is no lambda on the way except for texts that mix words and numbers
    kinds = {i: kind_of(events.select(column(c)).schema[0].dataType) for i, c in enumerate(columns) if c in shown}
    texts = events.select(
        *keep,
        *[column(c).cast("string").alias(f"_v{i}") for i, c in enumerate(columns)],
        *[column(c).alias(f"_n{i}") for i, c in enumerate(columns) if kinds.get(i) == "decimal"],
    )
    printed = {"text": lambda i: round_decimals(f"_v{i}"), "decimal": lambda i: rounded_decimal(f"_n{i}")}
    rounded = texts.withColumns({f"_r{i}": printed.get(k, lambda i: F.col(f"_v{i}"))(i) for i, k in kinds.items()})
    shape = Units(table, columns, kinds)
    if units:
        rounded = rounded.withColumn("_fit", F.expr(shape.used(max_tokens - 2)))
    split = rounded.withColumns({f"_t{i}": token_list(f"_r{i}") if k == "text" else characters(f"_r{i}") for i, k in kinds.items()})
    cut = split.withColumns(
        {f"_p{i}": digit_places(f"_r{i}", f"_t{i}") if k == "text" else typed_places(f"_r{i}", k) for i, k in kinds.items()}
    )

    # a column is used while the running length, its own included, leaves room for two tokens; the length
    # only grows, so what is used is a run of columns from the first on, and null columns add nothing
    no_tokens, no_numbers = "CAST(array() AS ARRAY<STRING>)", "CAST(array() AS ARRAY<INT>)"
    parts = {}
    for i, name in enumerate(columns):
        if name in codes:
            parts |= {f"_a{i}": no_tokens, f"_b{i}": no_numbers, f"_c{i}": no_numbers}
            continue
        label_tokens, label_places = constant_unit(name)
        own_types = f"concat({_array([TYPE_COLUMN] * len(label_tokens))}, array_repeat({TYPE_VALUE}, size(_t{i})))"
        for letter, unit, empty in (
            ("a", f"concat({_array(label_tokens)}, _t{i})", no_tokens),
            ("b", own_types, no_numbers),
            ("c", f"concat({_array(label_places)}, _p{i})", no_numbers),
        ):
            parts[f"_{letter}{i}"] = f"CASE WHEN _v{i} IS NULL THEN {empty} ELSE {unit} END"
    made = cut.withColumns({name: F.expr(unit) for name, unit in parts.items()})
    sums = F.expr(f"aggregate(array({', '.join(f'size(_a{i})' for i in range(len(columns)))}), "
                  f"struct({len(head_tokens)} AS length, 0 AS used), (s, n) -> struct(s.length + n AS length, "
                  f"s.used + CAST(s.length + n <= {max_tokens - 2} AS INT) AS used), s -> s.used)")  # fmt: skip
    made = made.withColumn("_used", F.col("_fit") if units else sums)

    def run(each) -> str:
        return f"slice(array({', '.join(each(i, c) for i, c in enumerate(columns))}), 1, _used)" if columns else "array()"

    def together(head: str, letter: str, kind: str) -> str:
        return f"concat({head}, flatten(CAST({run(lambda i, _: f'_{letter}{i}')} AS ARRAY<ARRAY<{kind}>>)))"

    shown_text = run(lambda i, c: "CAST(NULL AS STRING)" if c in codes else f"concat({text_literal(c + ' ')}, _v{i})")
    used_codes = [f"CASE WHEN {i} < _used AND _v{i} IS NOT NULL THEN array(_v{i}) ELSE {no_tokens} END" for i, c in enumerate(columns) if c in codes]
    return made.selectExpr(
        *keep,
        together(_array(head_tokens), "a", "STRING") + " AS tokens",
        together(_array([TYPE_TABLE] * len(head_tokens)), "b", "INT") + " AS types",
        together(_array(head_places), "c", "INT") + " AS places",
        f"concat_ws(' ', {text_literal(table)}, CAST({shown_text} AS ARRAY<STRING>)) AS original_text",
        f"concat({', '.join([no_tokens, *used_codes])}) AS codes",
        *([f"{shape.struct()} AS units"] if units else []),
    ).transform(shape.noted if units else lambda df: df)


def _array(values: list) -> str:
    return f"array({', '.join(str(v) if isinstance(v, int) else text_literal(v) for v in values)})"


def build_vocabulary(encoded: DataFrame, size: int | None = None, tokens: str = "tokens") -> DataFrame:
    """Token ids by falling frequency, then by token; digits and the point keep fixed ids.

    Every token gets an id, unless ``size`` asks for the most frequent ones only.  Numbering takes
    no single task: tokens are ranked inside parts (count, first three characters), the parts of a count are
    added up by prefix, and one running sum goes over the distinct counts, of which there are
    about the square root of twice the number of tokens at most.  Rows with ``units`` are counted by their values.
    """
    units = Units.of(encoded, tokens)
    if units:
        occurring = units.token_counts(encoded)
    else:
        occurring = encoded.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))
    counts = (
        occurring.where(~F.col("token").isin(*RESERVED))
        .withColumn("_part", F.substring("token", 1, 3))
    )
    parts = counts.groupBy("cnt", "_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.rowsBetween(Window.unboundedPreceding, -1)
    by_count = (
        parts.groupBy("cnt")
        .agg(F.sum("_n").alias("_n"))
        .select("cnt", F.coalesce(F.sum("_n").over(ahead.orderBy(F.desc("cnt"))), F.lit(0)).alias("_higher"))
    )
    within_count = F.sum("_n").over(ahead.partitionBy("cnt").orderBy("_part"))
    starts = parts.select("cnt", "_part", F.coalesce(within_count, F.lit(0)).alias("_before")).join(by_count, "cnt")
    place = F.row_number().over(Window.partitionBy("cnt", "_part").orderBy("token"))
    numbered = counts.withColumn("_place", place).join(
        starts.select("cnt", "_part", (F.col("_higher") + F.col("_before")).alias("_start")), ["cnt", "_part"]
    )
    numbered = numbered.select("token", "cnt", (F.col("_start") + F.col("_place") + (FIRST_ID - 1)).cast("int").alias("id"))
    return numbered if size is None else numbered.where(F.col("id") < FIRST_ID + size)


class Lookup:
    """A literal table of texts and what belongs to them, with two places for each text to be in."""

    def __init__(self, spark: SparkSession, wanted: dict[str, int | str], kind: str):
        self.slots = 4 * max(1, len(wanted))
        places = literal_rows(spark, [{"token": t} for t in wanted], "token: string")
        places = places.select("token", *[p.alias(f"at{k}") for k, p in enumerate(self._places(F.col("token")))]).collect()
        table: list[tuple[str, int | str] | None] = [None] * self.slots
        either = {r["token"]: (r["at0"], r["at1"]) for r in places}
        for token in wanted:
            self._put(table, either, token, wanted)
        self.kept = {entry[0] for entry in table if entry}
        entries = json.dumps([{"token": e[0], "id": e[1]} if e else None for e in table], ensure_ascii=False)
        self.table = F.from_json(F.lit(entries), f"array<struct<token: string, id: {kind}>>")

    def _places(self, token: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(token, *extra), F.lit(self.slots)).cast("int") for extra in ([], [F.lit(1)])]

    def _put(self, table: list, either: dict[str, tuple[int, int]], token: str, ids: dict[str, int | str]) -> None:
        """Moves what stands in the way to its other place, a bounded number of times; what is left over has no place."""
        at = either[token][0]
        for _ in range(64):
            pushed, table[at] = table[at], (token, ids[token])
            if pushed is None:
                return
            token = pushed[0]
            at = either[token][0] if either[token][1] == at else either[token][1]

    def id(self, token: Column) -> Column:
        """What belongs to the text, or null if it is not in the table."""
        found = [F.get(self.table, at) for at in self._places(token)]
        return F.coalesce(*[F.when(entry["token"] == token, entry["id"]) for entry in found])


def literal_rows(spark: SparkSession, entries: list[dict], kind: str) -> DataFrame:
    """Rows from the driver without a Python worker."""
    text = F.lit(json.dumps(entries, ensure_ascii=False))
    return spark.range(1).select(F.inline(F.from_json(text, f"array<struct<{kind}>>")))


class TokenHead(Lookup):
    """The most frequent tokens of a vocabulary as a literal table.

    ``whole`` tells that the vocabulary has no other tokens.
    """

    def __init__(self, vocabulary: DataFrame, tokens: int = HEAD_TOKENS, share: float = HEAD_SHARE, size: int = HEAD_BYTES):
        first = vocabulary.orderBy("id").limit(tokens + 1).select("token", "id", "cnt").collect()
        self.whole = len(first) <= tokens
        total = sum(r["cnt"] for r in first) if self.whole else vocabulary.agg(F.sum("cnt")).first()[0]
        wanted, seen, held = dict(RESERVED), 0, 0
        for r in first[:tokens]:
            held += len(r["token"].encode()) + 16
            if held > size or (not self.whole and seen > share * total):
                self.whole = False
                break
            wanted[r["token"]] = r["id"]
            seen += r["cnt"]
        super().__init__(vocabulary.sparkSession, wanted, "int")
        self.whole = self.whole and len(self.kept) == len(wanted)
        self.ids = {token: i for token, i in wanted.items() if token in self.kept}


class Units:
    """Rows as the printed values of their used columns: field ``v<i>`` of ``units`` for the i-th column, null where it is not used.

    All tokens of a row follow from the table's name, the columns' names and these values.  Names are counted by
    counting values, digits and points have fixed ids, and of texts the distinct ones are split.
    """

    def __init__(self, table: str, columns: list[str], kinds: dict[int, str]):
        self.table, self.columns, self.kinds = table, columns, kinds
        self.head = constant_unit(table)[0]
        self.labels = {i: constant_unit(columns[i])[0] for i in kinds}
        self.texts = [i for i, kind in kinds.items() if kind == "text"]

    @classmethod
    def of(cls, encoded: DataFrame, tokens: str) -> Units | None:
        """The units of a frame that has them and whose tokens are not asked for by another name."""
        if tokens != "tokens" or "units" not in encoded.columns:
            return None
        noted = encoded.schema["units"].metadata
        return cls(noted["table"], noted["columns"], dict(zip(noted["at"], noted["kinds"])))

    def noted(self, encoded: DataFrame) -> DataFrame:
        """The frame with what makes its units readable beside them, also after it has been saved."""
        notes = {"table": self.table, "columns": self.columns, "at": list(self.kinds), "kinds": list(self.kinds.values())}
        return encoded.withMetadata("units", notes)

    def used(self, room: int) -> str:
        """SQL over ``_r<i>``: how many columns, from the first on, leave the row within ``room`` tokens.

        No text has more tokens than bytes, so most rows need no splitting here.
        """
        if not self.kinds:
            return str(len(self.columns))
        size = {i: f"size({tokens_sql(f'_r{i}')})" if i in self.texts else f"length(_r{i})" for i in self.kinds}
        size = {i: f"CASE WHEN _r{i} IS NULL THEN 0 ELSE {len(self.labels[i])} + {n} END" for i, n in size.items()}
        exact = (
            f"aggregate(array({', '.join(size.get(i, '0') for i in range(len(self.columns)))}), "
            f"struct({len(self.head)} AS length, 0 AS used), (s, n) -> struct(s.length + n AS length, "
            f"s.used + CAST(s.length + n <= {room} AS INT) AS used), s -> s.used)"
        )
        most = room - len(self.head) - sum(map(len, self.labels.values()))
        together = f"concat_ws('', {', '.join(f'_r{i}' for i in self.kinds)})"
        return f"CASE WHEN octet_length({together}) <= {most} THEN {len(self.columns)} ELSE {exact} END"

    def struct(self) -> str:
        """SQL of the units."""
        fields = [f"'v{i}', CASE WHEN {i} < _used THEN _r{i} END" for i in self.kinds]
        return f"named_struct({', '.join(fields)})" if fields else "named_struct('none', CAST(NULL AS STRING))"

    def tokens(self) -> str:
        """SQL of a row's tokens."""
        split = {i: tokens_sql(f"units.v{i}") if i in self.texts else f"split(units.v{i}, '')" for i in self.kinds}
        empty = "CAST(array() AS ARRAY<STRING>)"
        own = [f"CASE WHEN units.v{i} IS NULL THEN {empty} ELSE concat({_array(self.labels[i])}, {split[i]}) END" for i in self.kinds]
        return f"concat({', '.join([_array(self.head), *own])})"

    def value_counts(self, encoded: DataFrame) -> DataFrame:
        """Distinct values with their occurrences: texts, dates and short numbers whole, of longer numbers what is neither digit nor point.

        Worked out once for a frame.
        """
        if not hasattr(encoded, "_value_counts"):
            values = []
            for i, kind in self.kinds.items():
                rest = f"translate(units.v{i}, '0123456789.', '')"
                short = f"CASE WHEN length(units.v{i}) <= {SHORT_NUMBER} THEN units.v{i} ELSE {rest} END"
                values.append(f"units.v{i}" if kind in ("text", "date") else short)
            rows = encoded.selectExpr(f"explode(CAST(array({', '.join(values)}) AS ARRAY<STRING>)) AS value").where("value <> ''")
            encoded._value_counts = saved(rows.groupBy("value").agg(F.count(F.lit(1)).alias("cnt")), "values")
        return encoded._value_counts

    def token_counts(self, encoded: DataFrame) -> DataFrame:
        """Occurrences of each token."""
        every = encoded.agg(F.count(F.lit(1)).alias("all"), *[F.count(f"units.v{i}").alias(f"v{i}") for i in self.kinds]).first()
        names = [(t, every["all"]) for t in self.head] + [(t, every[f"v{i}"]) for i in self.kinds for t in self.labels[i]]
        names = literal_rows(encoded.sparkSession, [{"token": t, "cnt": n} for t, n in names], "token: string, cnt: bigint")
        split = self.value_counts(encoded).select(F.explode(token_list("value")).alias("token"), "cnt")
        both = split.unionByName(names.where("cnt > 0"))
        return both.groupBy("token").agg(F.sum("cnt").alias("cnt"))

    def ids(self, encoded: DataFrame, head: TokenHead, missing: int, separator: str) -> Column:
        """Ids of a row's tokens as one text; ``missing`` for tokens outside the head.

        Nothing is done token by token: names and frequent values have their ids in a table, and the digits of other
        numbers are replaced.  Only other texts are split.
        """

        def written(found: list[str]) -> str:
            return "".join(f"{separator}{head.ids.get(t, missing)}" for t in found)

        def looked_up(found: Column) -> Column:
            ids = F.transform(found, lambda t: F.coalesce(head.id(t), F.lit(missing)))
            return F.array_join(F.transform(ids, lambda i: F.concat(F.lit(separator), i.cast("string"))), "")

        # the table stands in the plan for every column, so it is smaller than that of the tokens
        frequent = self.value_counts(encoded).where(f"length(value) <= {VALUE_LENGTH}")
        frequent = frequent.orderBy(F.desc("cnt"), "value").limit(HEAD_VALUES)
        frequent = frequent.select("value", looked_up(token_list("value")).alias("ids")).collect()
        known = Lookup(encoded.sparkSession, {r["value"]: r["ids"] for r in frequent}, "string")

        # printed numbers and dates are digits, points and hyphens; with an exponent or a plus they take the way of texts
        fixed = {**RESERVED, "-": head.ids.get("-", missing)}
        signs, stand_ins = "".join(fixed), "".join(chr(ord("a") + k) for k in range(len(fixed)))
        row: list[Column] = [F.lit(written(self.head))]
        for i, kind in self.kinds.items():
            value = F.col(f"units.v{i}")
            if kind == "text":
                ids = looked_up(token_list(f"units.v{i}"))
            else:
                text = F.translate(value, signs, stand_ins)
                for stand_in, number in zip(stand_ins, fixed.values()):
                    text = F.replace(text, F.lit(stand_in), F.lit(f"{separator}{number}"))
                odd = F.contains(value, F.lit("E")) | F.contains(value, F.lit("+"))
                ids = F.when(odd, looked_up(F.split(value, ""))).otherwise(text)
            seen = known.id(value) if kind in ("text", "date") else F.when(F.length(value) <= SHORT_NUMBER, known.id(value))
            row.append(F.when(value.isNull(), "").otherwise(F.concat(F.lit(written(self.labels[i])), F.coalesce(seen, ids))))
        return F.substr(F.concat(*row), F.lit(len(separator) + 1))


def encode_tokens(
    encoded: DataFrame, vocabulary: DataFrame, tokens: str = "tokens", out: str = "ids", separator: str | None = None
) -> DataFrame:
    """Token arrays as id arrays, or, with a separator, as texts of ids; tokens outside the vocabulary become the unknown id.

    The most frequent tokens, up to ``HEAD_SHARE`` of all occurrences and within ``HEAD_BYTES``, are a literal table with
    two hashed places for each, looked up where the row stands.  Rows that hold other tokens meet the
    vocabulary in a join: only distinct arrays, and of these only the places that the head leaves
    open, are exploded.  They are known by a 128-bit digest of the array, so nothing depends on the order of rows.
    Rows of head tokens alone are not shuffled.  A null array has no ids.  Rows with ``units`` need no tokens; theirs are made
    for the join alone.
    """
    head, units = TokenHead(vocabulary), Units.of(encoded, tokens)
    if units:
        if head.whole and separator and not re.search("[0-9a-z]", separator):
            return encoded.withColumn(out, units.ids(encoded, head, UNKNOWN_ID, separator))
        text = units.ids(encoded, head, UNKNOWN_ID if head.whole else -1, ",")
        looked_up = encoded.withColumn(out, F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<int>"))
    else:
        found = F.transform(tokens, lambda t: F.coalesce(head.id(t), F.lit(-1)))
        looked_up = encoded.withColumn(out, F.coalesce(found, F.array().cast("array<int>")))

    def finished(df: DataFrame) -> DataFrame:
        return df.withColumn(out, F.array_join(F.col(out).cast("array<string>"), separator)) if separator else df

    if head.whole and units:
        return finished(looked_up)
    if head.whole:
        unknown = F.transform(out, lambda i: F.when(i < 0, UNKNOWN_ID).otherwise(i))
        return finished(looked_up.withColumn(out, unknown))
    looked_up = saved(looked_up, "ids")
    rare = F.array_contains(out, -1)
    rest = looked_up.where(rare)
    if units and tokens not in encoded.columns:
        rest = rest.withColumn(tokens, F.expr(units.tokens()))
    rest = rest.withColumn("_digest", F.md5(F.to_json(F.struct(tokens))))
    arrays = rest.select("_digest", tokens, out).dropDuplicates(["_digest"])
    spread = arrays.select("_digest", F.posexplode(F.arrays_zip(F.col(tokens).alias("token"), F.col(out).alias("id"))).alias("_at", "_entry"))
    spread = spread.where("_entry.id < 0").select("_digest", "_at", "_entry.token")
    found = spread.join(vocabulary.select("token", "id"), "token", "left").select("_digest", "_at", F.coalesce("id", F.lit(UNKNOWN_ID)).alias("id"))
    found = found.groupBy("_digest").agg(F.map_from_entries(F.collect_list(F.struct("_at", "id"))).alias("_found"))
    filled = F.transform(out, lambda i, at: F.when(i >= 0, i).otherwise(F.try_element_at("_found", at)))
    rest = rest.join(found, "_digest").withColumn(out, filled).drop("_digest", "_found").select(looked_up.columns)
    return finished(looked_up.where(~rare).unionByName(rest))


def hourly_offsets(times: Column, hours: int) -> Column:
    """For each hour h the number of times before minute 60 h."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(hours - 1)),
        lambda h: F.size(F.filter(times, lambda t: t < h * 60)),
    )


def wrap_and_pad(values: Column, first: int, last: int, length: int) -> Column:
    """``first + values + last`` filled with zeros up to ``length``."""
    room = F.greatest(F.lit(0), F.lit(length - 2) - F.size(values))
    return F.concat(
        F.array(F.lit(first)), values, F.array(F.lit(last)), F.array_repeat(F.lit(0), room)
    ).cast("array<int>")


def stay_sequences(
    encoded: DataFrame,
    cohort: DataFrame,
    max_events: int = 256,
    max_tokens: int = 128,
    hours: int = 48,
    ties: list[str] | None = None,
) -> DataFrame:
    """One row per cohort stay with its latest events, wrapped, padded and in time order.

    Truncation comes before collecting, so a row holds at most ``max_events`` events.  Stays
    without events get one event of ones, offsets of zero and time 0.
    """
    ties = ties or ["original_text"]
    kept = latest_events(encoded, max_events, ties)
    entry = F.struct("TIME", *ties, *[c for c in ("ids", "types", "places", "original_text", "codes") if c not in ties])
    grouped = kept.groupBy("stay_id").agg(F.array_sort(F.collect_list(entry)).alias("_events"))

    def packed(field: str, first: int, last: int) -> Column:
        return F.transform("_events", lambda e: wrap_and_pad(e[field], first, last, max_tokens))

    times = F.transform("_events", lambda e: e["TIME"].cast("int"))
    sequences = grouped.select(
        "stay_id",
        packed("ids", CLS_ID, SEP_ID).alias("hi_input"),
        packed("types", TYPE_CLS, TYPE_SEP).alias("hi_type"),
        packed("places", PLACE_OTHER, PLACE_OTHER).alias("hi_place"),
        hourly_offsets(F.transform("_events", lambda e: e["TIME"]), hours).alias("hi_start"),
        times.alias("time"),
        F.transform("_events", lambda e: e["original_text"]).alias("original_texts"),
        F.flatten(F.transform("_events", lambda e: e["codes"])).alias("codes"),
    )
    ones = F.array(F.array_repeat(F.lit(1), max_tokens)).cast("array<array<int>>")
    defaults = {
        "hi_input": ones,
        "hi_type": ones,
        "hi_place": ones,
        "hi_start": F.array_repeat(F.lit(0), hours),
        "time": F.array(F.lit(0)),
        "original_texts": F.array().cast("array<string>"),
        "codes": F.array().cast("array<string>"),
    }
    return cohort.join(sequences, "stay_id", "left").withColumns(
        {name: F.coalesce(F.col(name), default) for name, default in defaults.items()}
    )
