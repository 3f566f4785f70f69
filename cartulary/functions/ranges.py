"""Ranges of file names: the one differing number of two bounds, and the names between them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cartulary.functions.keys import basename, dirname, splitext_extension, stem


def tokens(x: Column) -> Column:
    """Runs of digits and of other characters."""
    return F.regexp_extract_all(x, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _differing(a: Column, b: Column) -> Column:
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size(a) - 1, F.lit(0))), lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i)))
    return bind(places, lambda p: F.when((F.size(a) == F.size(b)) & (F.size(p) == 1), F.get(p, F.lit(0))))


def varying_token(first: Column, last: Column) -> Column:
    """Index of the only token that differs, if it is a number on both sides; else null."""

    def index(t: Column) -> Column:
        number = lambda i: F.get(t["a"], i).rlike("^[0-9]+$") & F.get(t["b"], i).rlike("^[0-9]+$")
        return bind(_differing(t["a"], t["b"]), lambda i: F.when(number(i), i))

    return bind(F.struct(tokens(first).alias("a"), tokens(last).alias("b")), index)


def expand(first: Column, last: Column) -> Column:
    """All names from ``first`` to ``last``, numbers padded to the first one's width.

    Directory and extension are the first one's.  Null where not exactly one number
    differs (equal bounds too), or the numbers descend.
    """
    base, folder = basename(first), dirname(first)
    lead = F.when(F.contains(first, F.lit("/")), F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))).otherwise(F.lit(""))
    parts = F.struct(tokens(stem(base)).alias("a"), tokens(stem(basename(last))).alias("b"), lead.alias("lead"), splitext_extension(base).alias("ext"))

    def names(p: Column, i: Column) -> Column:
        ends = F.struct(
            F.concat(p["lead"], F.array_join(F.slice(p["a"], F.lit(1), i), "")).alias("head"),
            F.concat(F.array_join(F.slice(p["a"], i + 2, F.greatest(F.size(p["a"]), F.lit(1))), ""), p["ext"]).alias("foot"),
            F.length(F.get(p["a"], i)).alias("width"),
            F.get(p["a"], i).try_cast("long").alias("x"),
            F.get(p["b"], i).try_cast("long").alias("y"),
        )

        def name(e: Column, n: Column) -> Column:
            digits = n.cast("string")
            return F.concat(e["head"], F.lpad(digits, F.greatest(e["width"], F.length(digits)), F.lit("0")), e["foot"])

        return bind(ends, lambda e: F.when(e["y"] >= e["x"], F.transform(F.sequence(e["x"], F.greatest(e["x"], e["y"])), lambda n: name(e, n))))

    return bind(parts, lambda p: bind(_differing(p["a"], p["b"]), lambda i: F.when(i.isNotNull(), names(p, i))))


def with_span(df: DataFrame, first: Column, last: Column, name: str = "span") -> DataFrame:
    """``df`` with a struct head, foot, width, lo, hi of the names from ``first`` to ``last``; null where ``expand`` is.

    Tokens are columns of their own, so that each is cut once and the rest is compiled."""
    base, folder = basename(first), dirname(first)
    lead = F.when(F.contains(first, F.lit("/")), F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))).otherwise(F.lit(""))
    a, b, i = F.col("_a"), F.col("_b"), F.col("_i")
    name_, ext = F.col("_name"), F.substring("_base", F.length("_name") + 1, F.lit(1 << 20))
    d = df.withColumns({"_lead": lead, "_base": base, "_name": stem(base), "_b": tokens(stem(basename(last)))})
    d = d.withColumns({"_ext": ext, "_a": tokens(name_)}).drop("_base", "_name")
    d = d.withColumn("_other", F.when(F.size(a) == F.size(b), F.zip_with(a, b, lambda x, y: x != y)))
    d = d.withColumn("_i", F.when(F.size(F.array_remove("_other", F.lit(False))) == 1, F.array_position("_other", F.lit(True)).cast("int")))
    x, y = F.get(a, i - 1), F.get(b, i - 1)
    d = d.withColumns({"_x": x, "_lo": F.when(x.rlike("^[0-9]+$"), x.try_cast("long")), "_hi": F.when(y.rlike("^[0-9]+$"), y.try_cast("long"))})
    head = F.concat("_lead", F.array_join(F.slice(a, F.lit(1), F.greatest(i - 1, F.lit(0))), ""))
    foot = F.concat(F.array_join(F.slice(a, i + 1, F.size(a)), ""), F.col("_ext"))
    made = F.struct(head.alias("head"), foot.alias("foot"), F.length("_x").alias("width"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi"))
    return d.withColumn(name, F.when(F.col("_hi") >= F.col("_lo"), made)).drop("_lead", "_ext", "_a", "_b", "_other", "_i", "_x", "_lo", "_hi")


def members(df: DataFrame, name: str = "span", href: str = "href") -> DataFrame:
    """A row for each name of a span, with its ``position`` and the span's ``size``; rows without a span go."""
    s = F.col(name)
    out = df.select("*", F.explode(F.sequence(s["lo"], s["hi"])).alias("_n"))  # a test for null would be pushed below and cut the tokens again
    digits = F.col("_n").cast("string")
    made = F.concat(s["head"], F.lpad(digits, F.greatest(s["width"], F.length(digits)), F.lit("0")), s["foot"])
    size = (s["hi"] - s["lo"] + 1).cast("int")
    return out.withColumns({href: made, "size": size, "position": position((F.col("_n") - s["lo"]).cast("int"), size)}).drop(name, "_n")


def position(index: Column, size: Column) -> Column:
    return F.when(index == 0, F.lit("first")).when(index == size - 1, F.lit("last")).otherwise(F.lit("intermediaire"))


def bound(role: Column) -> Column:
    """Struct prefix, position of a range bound's role in either spelling; null for other roles."""
    colon = r"^(.*):(first|last)$"
    flat = r"^(first|last)_image$"
    return F.when(
        role.rlike(colon), F.struct(F.regexp_extract(role, colon, 1).alias("prefix"), F.regexp_extract(role, colon, 2).alias("position"))
    ).when(role.rlike(flat), F.struct(F.lit("image").alias("prefix"), F.regexp_extract(role, flat, 1).alias("position")))
