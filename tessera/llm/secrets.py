r"""Secret scans with multipart credential linking.

Strong kinds are reported wherever they match: ``assign`` (a keyword
assigned a value of 6 or more characters), ``access`` (an access key id) and ``hex``
(a long hexadecimal run). Weak parts (a named identifier, a bare
high-entropy value, an endpoint URL) mean nothing alone. They are reported only when complementary parts
co-occur within a scope: an identifier (weak or ``access``) and a value (weak
or ``hex`` or the value of an ``assign``), or one of these and an endpoint, no further apart than ``reach`` characters.

Everything is DataFrame code. Positions come from ``split`` and ``regexp_extract_all`` by the same pattern: the lengths
of the pieces between the matches and of the matches add up to code-point offsets, in a window over the matches of each distinct text, so the work is
proportional to their number. An interval join on (text, scope) pairs each weak candidate with the parts of the scopes it reaches, so a
text of any length is worked on by many tasks and no text is compared with another. Every document is scanned by the patterns once; :func:`redact` looks at it once
more to tell the few texts that need a join from those that stay as they are.

Cases: null and empty texts have no spans; equal texts are scanned alike and linked once;
very long texts are scanned whole; spans of different kinds may overlap. Other columns are ignored or kept as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.components import written

# fixed patterns of the strong kinds; a match under the least length is dropped
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# weak parts
IDENT = (r"""(?i)\b(?:access_?key_?id|client_?id|key_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*"""
         r"""["']?[A-Za-z0-9_.@-]{4,}""")
VALUE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9a-z+/_=-]*[A-Z])[A-Za-z0-9+/_=-]{20,}"
ENDPOINT = r"""(?i)\b(?:https?|s3|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+"""
KINDS = ("assign", "access", "hex", "weak_id", "weak_value", "endpoint")
REACH = 400
PIECE = 1024
MASK = "[SECRET]"
SPAN = "array<struct<kind:string,start:int,end:int>>"


def lists(text: Column, pattern: str, kind: str, test: Column, keep: Column | None = None) -> Column:
    """struct<kind, gaps, sizes, keep>: lengths of the pieces before each match and of the matches, null without a match."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(test, F.struct(
        F.lit(kind).alias("kind"), F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
        F.transform(whole, F.length).alias("sizes"),
        (F.transform(whole, lambda _: F.lit(True)) if keep is None else keep).alias("keep")))


def tests(text: Column) -> dict[str, Column]:
    """Whether a text has a match of each kind, the cheapest tests first."""
    assigns = text.contains("=") | text.contains(":")
    return {"assign": assigns & text.rlike(ASSIGN), "access": text.contains("AKIA") & text.rlike(ACCESS), "hex": text.rlike(HEX),
            "weak_id": assigns & text.rlike(IDENT), "weak_value": text.rlike(VALUE), "endpoint": text.contains("://") & text.rlike(ENDPOINT)}


def match_lists(text: Column) -> Column:
    """The match lists of all kinds that a text has."""
    pattern = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, IDENT, VALUE, ENDPOINT)))
    long_enough = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_LEAST)
    found = [lists(text, pattern[k], k, test, long_enough if k == "assign" else None) for k, test in tests(text).items()]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def parts_of(found: DataFrame) -> DataFrame:
    """(k1, k2, kind, start, end) of the kept matches of each distinct text of ``found`` (k1, k2, lists)."""
    once = found.groupBy("k1", "k2").agg(F.first("lists").alias("lists")).select("k1", "k2", F.explode("lists").alias("x"))
    each = once.select("k1", "k2", "x.kind", F.posexplode(F.arrays_zip(
        F.slice("x.gaps", F.lit(1), F.size("x.sizes")).alias("g"), F.col("x.sizes").alias("n"), F.col("x.keep").alias("keep"))).alias("pos", "m"))
    run = Window.partitionBy("k1", "k2", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.g") + F.col("m.n")).over(run).cast("int")
    placed = each.select("k1", "k2", "kind", "m.n", "m.keep", end.alias("end"))
    return placed.where("keep").select("k1", "k2", "kind", (F.col("end") - F.col("n")).alias("start"), "end")


def linked_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak rows of ``parts`` (k1, k2, kind, start, end) that have a complement within reach."""
    role = (F.when(F.col("kind").isin("access", "weak_id"), F.lit("id"))
             .when(F.col("kind").isin("assign", "hex", "weak_value"), F.lit("value")).otherwise(F.lit("endpoint")))
    parts = parts.withColumn("role", role)
    # a part is filed in every scope it touches; a candidate asks for the scopes it reaches
    filed = parts.withColumn("scope", F.explode(F.sequence(
        F.floor(F.col("start") / reach), F.floor((F.col("end") - 1) / reach)))).select(
        "k1", "k2", "scope", F.col("role").alias("r2"), F.col("start").alias("s2"), F.col("end").alias("e2"))
    asks = parts.where(F.col("kind").isin(*KINDS[3:])).withColumn("scope", F.explode(F.sequence(
        F.floor(F.greatest(F.col("start") - reach, F.lit(0)) / reach), F.floor((F.col("end") + reach) / reach))))
    near = (F.col("s2") <= F.col("end") + reach) & (F.col("e2") >= F.col("start") - reach) & (F.col("role") != F.col("r2"))
    return asks.join(filed, ["k1", "k2", "scope"]).where(near).select("k1", "k2", "kind", "start", "end").distinct()


def reported(found: DataFrame, reach: int = REACH) -> DataFrame:
    """(k1, k2, kind, start, end): strong matches and linked weak ones."""
    parts = written(parts_of(found), "parts")
    return parts.where(F.col("kind").isin(*KINDS[:3])).unionByName(linked_parts(parts, reach))


def rank_of(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def by_text(spans: DataFrame) -> DataFrame:
    """(k1, k2, spans): the spans of a text by start, then kind as listed, then end."""
    keyed = F.sort_array(F.collect_list(F.struct("start", rank_of(F.col("kind")).alias("rank"), "end", "kind")))
    return spans.groupBy("k1", "k2").agg(keyed.alias("s")).select("k1", "k2", F.transform("s", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Counts and digest columns per document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = written(docs.select(F.col(id_col), *keys(text), match_lists(text).alias("lists")), "found")
    has = F.size("lists") > 0
    spans = by_text(reported(found.where(has).select("k1", "k2", "lists"), reach))
    # only rows with a match take part in the join
    none = F.array().cast(SPAN)
    asked = found.where(has).join(spans, ["k1", "k2"], "left").select(id_col, F.coalesce("spans", none).alias("spans"))
    every = asked.unionByName(found.where(~has).select(id_col, none.alias("spans")))
    every = every.withColumn("base", F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3])))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return every.select(id_col, count("assign"), count("access"), count("hex"),
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def kept_ranges(spans: DataFrame) -> DataFrame:
    """(k1, k2, kept): what lies between the spans of a text, as array<struct<at, upto>>; the last range has no end."""
    before = Window.partitionBy("k1", "k2").orderBy("start", rank_of(F.col("kind")), "end").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.max("end").over(before), F.lit(0))
    rows = spans.withColumn("at", at).withColumn("fresh", F.col("start") >= F.col("at"))
    between = F.collect_list(F.when(F.col("fresh"), F.struct("at", F.col("start").alias("upto"))))
    last = F.array(F.struct(F.max("end").alias("at"), F.lit(None).cast("int").alias("upto")))
    return rows.groupBy("k1", "k2").agg(F.concat(F.sort_array(between), last).alias("kept"))


def without(text: Column, kept: Column, mask: str) -> Column:
    """The kept ranges of ``text`` joined by ``mask``. The text is cut into pieces once, so a range costs its own length."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def upto_of(r: Column, n: Column) -> Column:
        return F.coalesce(r["upto"], n)

    def range_text(pieces: Column, n: Column, r: Column) -> Column:
        a, b = r["at"], upto_of(r, n)
        first, last = F.floor(a / PIECE).cast("int"), F.floor(b / PIECE).cast("int")
        head, tail = F.coalesce(F.get(pieces, first), F.lit("")), F.coalesce(F.get(pieces, last), F.lit(""))
        middle = F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        return F.when(first == last, head.substr(a % PIECE + 1, b - a)).otherwise(
            F.concat(head.substr(a % PIECE + 1, F.lit(PIECE)), middle, tail.substr(F.lit(1), b % PIECE)))

    # the pieces are an argument of the lambda, so that they are made once for a text
    return F.element_at(F.transform(F.array(F.struct(cut.alias("p"), F.length(text).alias("n"))), lambda c: F.array_join(
        F.transform(kept, lambda r: range_text(c["p"], c["n"], r)), mask)), 1)


def redact(docs: DataFrame, text_col: str = "text", mask: str = MASK, length_col: str | None = None, reach: int = REACH) -> DataFrame:
    """``docs`` with every reported span of the text replaced by ``mask`` (overlapping spans as one);
    ``length_col``, if given, becomes the new length of changed texts. All columns stay."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = written(docs.select(*keys(text), match_lists(text).alias("lists")).where(F.size("lists") > 0), "found")
    kept = kept_ranges(reported(found, reach))
    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"))
    suspect = F.coalesce(reduce(lambda a, b: a | b, tests(F.col("text")).values()), F.lit(False))
    asked = rows.where(suspect).select("*", *keys(F.col("text"))).join(kept, ["k1", "k2"], "left").select(
        "doc", F.when(F.col("kept").isNotNull(), without(F.col("text"), F.col("kept"), mask)).otherwise(F.col("text")).alias("text"),
        F.col("kept").isNotNull().alias("changed"))
    out = asked.unionByName(rows.where(~suspect).withColumn("changed", F.lit(False)))

    def column(field) -> Column:
        own = F.col("doc")[field.name]
        if field.name == text_col:
            own = F.col("text")
        elif field.name == length_col:
            own = F.when(F.col("changed"), F.length("text")).otherwise(own).cast(field.dataType)
        return own.alias(field.name)

    return out.select(*[column(f) for f in docs.schema.fields])
