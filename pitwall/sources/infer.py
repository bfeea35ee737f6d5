"""Column types found in text, as one partial aggregate over the scan.

Types form a lattice: whole numbers (``int``, ``bigint``) lie below exact decimals, those below ``double``; ``date`` lies
below ``timestamp``; ``boolean`` stands alone; ``string`` is above all. For every column the aggregate counts how many of
its values have a form of each kind, with the digits they need, so the join of all its values' types and what a
narrower type would lose follow from one row of counts: no second pass, no sample, and every task sends one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Forms of values, on trimmed text. No infinities, hexadecimal digits or type suffixes.
WHOLE = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
SCIENTIFIC = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"
BOOLEAN = r"^([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])$"
MAX_DIGITS = 38
MEASURES = ("filled", "ints", "longs", "wholes", "numbers", "doubles", "dates", "timestamps", "booleans", "digits", "scale")


def _measures(c: str) -> dict[str, Column]:
    t = F.trim(F.col(f"`{c}`"))
    number = t.rlike(NUMBER)
    before = F.length(F.regexp_extract(t, r"^[+-]?0*([0-9]*)", 1))
    after = F.length(F.regexp_extract(t, r"[.]([0-9]*?)0*$", 1))
    count = lambda cond: F.count(F.when((t != "") & cond, 1))
    return {
        "filled": count(F.lit(True)),
        "ints": count(t.rlike(WHOLE) & t.try_cast("int").isNotNull()),
        "longs": count(t.rlike(WHOLE) & t.try_cast("bigint").isNotNull()),
        "wholes": count(t.rlike(WHOLE)),
        "numbers": count(number),
        "doubles": count(t.rlike(SCIENTIFIC) & t.try_cast("double").isNotNull()),
        "dates": count(t.rlike(DATE) & t.try_cast("date").isNotNull()),
        "timestamps": count(t.rlike(TIMESTAMP) & t.try_cast("timestamp").isNotNull()),
        "booleans": count(t.rlike(BOOLEAN)),
        "digits": F.coalesce(F.max(F.when(number, before)), F.lit(0)).cast("bigint"),
        "scale": F.coalesce(F.max(F.when(number, after)), F.lit(0)).cast("bigint"),
    }


def type_counts(df: DataFrame, columns=None) -> DataFrame:
    """One row per text column: the rows, and the counts of ``MEASURES``."""
    columns = list(columns or df.columns)
    measures = {c: _measures(c) for c in columns}
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[e.alias(f"{k}_{m}") for k, c in enumerate(columns) for m, e in measures[c].items()])
    rows = [F.struct(F.lit(c).alias("column"), F.col("rows"), *[F.col(f"{k}_{m}").alias(m) for m in MEASURES]) for k, c in enumerate(columns)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def inferred(df: DataFrame, columns=None) -> DataFrame:
    """The type of every text column, and what the next narrower kind would lose.

    ``type`` has a form for every filled value (a column without any is ``string``). ``nearest`` is the kind that most
    values have (the narrowest of equal ones), and ``lost`` counts the filled values without its form: a column of
    numbers with a few markers is ``string``, nearest ``bigint``, and says how many markers there are.
    """
    n = F.col("filled")
    precise = F.concat(F.lit("decimal("), F.greatest(F.col("digits") + F.col("scale"), F.lit(1)), F.lit(","), F.col("scale"), F.lit(")"))
    fits = F.col("digits") + F.col("scale") <= MAX_DIGITS
    exact = (F.when(F.col("ints") == n, "int").when(F.col("longs") == n, "bigint")
             .when((F.col("numbers") == n) & fits, precise).when(F.col("doubles") == n, "double")
             .when(F.col("booleans") == n, "boolean").when(F.col("dates") == n, "date").when(F.col("timestamps") == n, "timestamp"))
    kinds = (("int", "ints"), ("bigint", "longs"), ("number", "numbers"), ("double", "doubles"), ("boolean", "booleans"),
             ("date", "dates"), ("timestamp", "timestamps"))
    most = F.greatest(*[F.col(c) for _, c in kinds])
    nearest = None
    for kind, c in kinds:
        hit = F.col(c) == most
        nearest = F.when(hit, kind) if nearest is None else nearest.when(hit, kind)
    some = (n > 0) & (most > 0)
    return type_counts(df, columns).select(
        "column", "rows", "filled", F.when(n > 0, exact).otherwise(None).alias("exact"),
        F.when(some, nearest).alias("nearest"), F.when(some, n - most).otherwise(n).alias("lost")) \
        .select("column", "rows", "filled", F.coalesce("exact", F.lit("string")).alias("type"), "nearest", "lost")


def inferred_types(df: DataFrame, decimals: str | None = "double") -> dict[str, str]:
    """{column: type} for ``apply_types``: one small row per column comes to the driver. Fractions become ``decimals``
    (None keeps the exact decimal type)."""
    out = {}
    for r in inferred(df).select("column", "type").collect():
        if r["type"] != "string":
            out[r["column"]] = decimals if decimals and r["type"].startswith("decimal") and not r["type"].endswith(",0)") else r["type"]
    return out
