"""Snapshot extrapolation (R1): next = (current - previous) + current.

Snapshots are tables of state rows ``(pos, state ARRAY<VARIANT>)`` (plus
optional grouping columns such as a snapshot id), as produced by
``parse.snapshot_split``. Pairing current with previous rows is an equi-join
(by list position, or by a key element), and the per-element rules are one
``transform`` over the array: no UDF, no driver loop, no group holding a
whole snapshot.

Rules (per element ``j`` of a current row):
  a. number (or boolean, which counts as 0/1) in both -> ``(c - p) + c``;
     integer op integer stays integer, anything else is DOUBLE;
  b. string, null or mismatched type -> current value;
  c. no previous row -> current row;
  d. previous row shorter -> current value for the missing positions;
  e. positions 8 and 17 (when present) -> boolean (null -> false, number -> != 0,
     string -> non-empty);
  f. positions 3 and 4 and the snapshot ``time`` -> the job time.
  g. no previous snapshot at all -> current snapshot unchanged.

``fix_booleans=True`` keeps current booleans instead of doing arithmetic on
them (parity mode turns True->False at position 8 into True, and leaves
numbers at other boolean positions). ``steps=n`` applies the step ``n``
times against the same previous snapshot, like a generator that overwrites
the current file every cycle.

``extrapolate_named`` is the same for a snapshot table of typed columns: plain
arithmetic in generated code, and ``n`` steps in closed form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.operators.dedup import latest_per_key

# Positions coerced to boolean, and positions stamped with the
# job time.
BOOLEAN_POSITIONS = (8, 17)
TIME_POSITIONS = (3, 4)

_INTEGRAL = ["TINYINT", "SMALLINT", "INT", "BIGINT", "BOOLEAN"]
_FRACTIONAL = ["FLOAT", "DOUBLE"]


def _kind(tag: Column) -> Column:
    """2 for the tag of an integer (or boolean), 1 of another number, else 0."""
    return (F.when(tag.isin(_INTEGRAL), 2).when(tag.isin(_FRACTIONAL), 1)
            .when(tag.startswith("DECIMAL"), F.when(tag.endswith(",0)"), 2).otherwise(1)).otherwise(0))


def _truthy(v: Column, tag: Column) -> Column:
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit(False))
            .when(tag == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
            .when(tag.startswith("ARRAY") | tag.startswith("OBJECT"),
                  F.coalesce(F.size(F.try_variant_get(v, "$", "array<variant>")) > 0, F.lit(True)))
            .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != 0, F.lit(False))))


def _steps(cur: Column, prev: Column, job_time: Column, steps: int, fix_booleans: bool) -> Column:
    # Pass 1: each element with its previous value and both type tags, so
    # ``schema_of_variant`` runs once per value, however many steps there are.
    tagged = F.transform(cur, lambda c, i: F.struct(
        c.alias("c"), F.schema_of_variant(c).alias("ct"),
        F.get(prev, i).alias("p"), F.schema_of_variant(F.get(prev, i)).alias("pt")))

    kinds = F.transform(tagged, lambda e: F.struct(
        e["c"].alias("c"), e["ct"].alias("ct"), _kind(e["ct"]).alias("ck"), e["p"].alias("p"), _kind(e["pt"]).alias("pk")))

    # Pass 2: what the steps count with. ``ci`` and ``pi`` are there for two
    # integers, ``cd`` and ``pd`` for two numbers (``pd`` for a previous one).
    def numbers(e: Column) -> Column:
        c, ct, p = e["c"], e["ct"], e["p"]
        both = (e["ck"] > 0) & (e["pk"] > 0)
        if fix_booleans:
            both = both & (F.coalesce(ct, F.lit("")) != "BOOLEAN")
        whole = both & (e["ck"] == 2) & (e["pk"] == 2)
        as_type = lambda cond, v, typ: F.when(cond, F.try_variant_get(v, "$", typ))
        return F.struct(c.alias("c"), ct.alias("ct"), both.alias("both"),
                        as_type(whole, c, "bigint").alias("ci"), as_type(whole, p, "bigint").alias("pi"),
                        as_type(both, c, "double").alias("cd"), as_type(e["pk"] > 0, p, "double").alias("pd"))

    # Integers stay integers; past BIGINT the result is DOUBLE (never an ANSI
    # overflow error), and stays one in the steps after.
    def whole_step(i: Column, pi: Column) -> Column:
        return F.try_add(F.try_subtract(i, pi), i)

    def step(s: Column, e: Column) -> Column:
        new = whole_step(s["i"], e["pi"])
        return F.struct(new.alias("i"), F.coalesce(new.cast("double"), (s["d"] - e["pd"]) + s["d"]).alias("d"))

    number = lambda i, d: F.coalesce(i.cast("variant"), d.cast("variant"))

    # Pass 3: the rules.
    def moved(e: Column) -> Column:
        if steps == 1:
            return number(whole_step(e["ci"], e["pi"]), (e["cd"] - e["pd"]) + e["cd"])
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.struct(e["ci"].alias("i"), e["cd"].alias("d")),
                           lambda s, _: step(s, e), lambda s: number(s["i"], s["d"]))

    def flag(e: Column) -> Column:
        one = F.coalesce(whole_step(e["ci"], e["pi"]) != 0, (e["cd"] - e["pd"]) + e["cd"] != 0, F.lit(False))
        first = F.when(e["both"], one).otherwise(_truthy(e["c"], e["ct"]))
        if steps == 1 or fix_booleans:
            return first
        bit = lambda b: b.cast("double")
        more = F.aggregate(F.sequence(F.lit(2), F.lit(steps)), first, lambda b, _: (bit(b) - e["pd"]) + bit(b) != 0)
        return F.when(e["pd"].isNotNull(), more).otherwise(first)

    def element(e: Column, i: Column) -> Column:
        return (F.when(i.isin(list(TIME_POSITIONS)), job_time.cast("bigint").cast("variant"))
                .when(i.isin(list(BOOLEAN_POSITIONS)), flag(e).cast("variant"))
                .when(e["both"], moved(e))
                .otherwise(e["c"]))
    return F.transform(F.transform(kinds, numbers), element)


def extrapolate(current: DataFrame, previous: DataFrame | None, job_time,
                by: Sequence[str] = (), key_index: int | None = None,
                steps: int = 1, fix_booleans: bool = False,
                state_col: str = "state", pos_col: str = "pos") -> DataFrame:
    """Next snapshot from ``previous`` and ``current``.

    ``by`` pairs snapshots group by group (e.g. a snapshot id already aligned
    between the two frames); rows pair on ``by`` + list position, or on
    ``by`` + the element at ``key_index`` (e.g. 0 = icao24) when given.
    ``job_time`` is an epoch in seconds (int or Column). Output columns:
    ``by``, ``time``, ``pos``, ``state``.

    Of several previous rows at one (``by``, ``pos``) one is used, the first by
    its text, so pairing never multiplies rows. Documents split into pages
    restart ``pos`` per page; ``snapshots.latest_two`` numbers them through.
    """
    if int(steps) < 1:
        raise ValueError("steps counts from 1")
    by = list(by)
    if previous is None:  # rule g
        return current.select(*by, "time", pos_col, state_col)
    t = job_time if isinstance(job_time, Column) else F.lit(int(job_time))
    if key_index is None:
        on = by + [pos_col]
        # The window partitions by the join's own keys: no shuffle on top.
        prev = latest_per_key(previous, on, [F.to_json(F.col(state_col)).asc()]).select(
            *on, F.col(state_col).alias("_prev"))
    else:
        key = F.try_variant_get(F.get(F.col(state_col), key_index), "$", "string")
        # One previous row per key (the first in list order), so pairing can
        # never multiply rows.
        prev = latest_per_key(previous.withColumn("_key", key), by + ["_key"],
                              [F.col(pos_col).asc()]).select(*by, "_key",
                                                             F.col(state_col).alias("_prev"))
        current = current.withColumn("_key", key)
        on = by + ["_key"]
    j = current.join(prev, on=on, how="left")
    arr = _steps(F.col(state_col), F.col("_prev"), t, int(steps), fix_booleans)  # its size does not grow with ``steps``
    return j.select(*by, t.cast("bigint").alias("time"), F.col(pos_col), arr.alias(state_col))


def _ahead(c: Column, p: Column, steps: int, whole: bool) -> Column:
    """``c + (2^steps - 1) (c - p)`` where both are there, else ``c``. An integer
    past BIGINT is null."""
    if whole:
        c, p = c.cast("bigint"), p.cast("bigint")
        gap = F.try_subtract(c, p)
        far = F.try_multiply(gap, F.lit(2 ** steps - 1).cast("bigint")) if steps < 64 else F.when(gap == 0, gap)
        moved = F.try_add(c, far)
    else:
        moved = c + F.lit(2.0 ** steps - 1) * (c - p)
    return F.when(c.isNotNull() & p.isNotNull(), moved).otherwise(c)


def _ground_ahead(c: Column, p: Column, steps: int) -> Column:
    """Rule e after every step: from the second one on nothing changes."""
    number = lambda b: b.cast("int")
    for _ in range(min(steps, 2)):
        c = F.coalesce(F.when(p.isNotNull() & c.isNotNull(), 2 * number(c) - number(p) != 0).otherwise(c), F.lit(False))
    return c


def extrapolate_named(current: DataFrame, previous: DataFrame | None, job_time, fields: Sequence[tuple[str, str]],
                      by: Sequence[str] = (), key: str | None = None, steps: int = 1,
                      fix_booleans: bool = False, pos_col: str = "pos") -> DataFrame:
    """``extrapolate`` for snapshots whose values are typed columns: ``fields``
    names them with their types, in position order (``parse.positional_to_named``
    makes such a table). Rows pair on ``by`` and the list position, or on ``by``
    and the column ``key``; of several previous rows the first in list order is used.

    ``n`` steps are ``c + (2^n - 1)(c - p)``, computed once for each value; the
    job times and the booleans of rules e and f come after. Booleans at other
    positions become numbers, as there (``fix_booleans`` keeps them). A table of
    columns does not tell a null from a missing value: a field at position 17
    counts as present. Output: ``by``, ``time``, ``pos``, the fields.
    """
    if int(steps) < 1:
        raise ValueError("steps counts from 1")
    if int(steps) > 1000:
        raise ValueError("2^steps is no longer a DOUBLE")
    names = [n for n, _ in fields]
    if previous is None:  # rule g
        return current.select(*by, "time", pos_col, *names)
    t = (job_time if isinstance(job_time, Column) else F.lit(int(job_time))).cast("bigint")
    on = [*by, key or pos_col]
    one = latest_per_key(previous, on, [F.col(pos_col).asc(), F.to_json(F.struct(*names)).asc()])
    prev = one.select(*on, *[F.col(n).alias(f"_prev_{n}") for n in names if n not in on])
    j = current.join(prev, on=on, how="left")

    def value(i: int, name: str, typ: str) -> Column:
        c, p = F.col(name), F.col(name if name in on else f"_prev_{name}")
        if i in TIME_POSITIONS:
            return t
        if typ == "boolean":
            if fix_booleans:
                return F.coalesce(c, F.lit(False)) if i in BOOLEAN_POSITIONS else c
            return _ground_ahead(c, p, steps) if i in BOOLEAN_POSITIONS else _ahead(c, p, steps, whole=True)
        if typ in ("int", "bigint", "double"):
            moved = _ahead(c, p, steps, whole=typ != "double")
            return F.coalesce(moved != 0, F.lit(False)) if i in BOOLEAN_POSITIONS else moved
        return c

    return j.select(*by, t.alias("time"), F.col(pos_col), *[value(i, n, typ).alias(n) for i, (n, typ) in enumerate(fields)])


def to_documents(df: DataFrame, by: Sequence[str] = (), page_size: int = 10_000) -> DataFrame:
    """State rows ``(time, pos, state)`` -> whole snapshot documents ``{"time",
    "states"}`` in pieces of at most ``page_size`` states: columns ``by``,
    ``time``, ``page_no`` and ``value`` (the JSON text). The pieces of a snapshot
    in the order of their numbers hold its states in list order."""
    rows = df.withColumn("page_no", F.floor(F.col("pos") / F.lit(int(page_size))).cast("int"))
    by_pos = lambda a, b: F.when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0)
    pages = (rows.groupBy(*by, "time", "page_no")
             .agg(F.array_sort(F.collect_list(F.struct("pos", "state")), by_pos).alias("_rows")))
    body = F.struct(F.col("time"), F.transform("_rows", lambda r: r["state"]).alias("states"))
    return pages.select(*by, "time", "page_no", F.to_json(body).alias("value"))
