"""Operator 8: secret scan with corpus-wide ownership, with DataFrame functions only.

Patterns find base spans in each text. Besides, any long run of letters and digits that
looks random is a candidate. All values are hashed and counted over the corpus: in how
many repositories (documents) and by how many owners (sources). A value that many owners
have, or that few owners have in very many of their documents, is an example that was copied; a live-looking other one is a
credential, and is added as a span of kind ``owned`` where no base span covers it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import small, staged

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs are maximal, so a bound on their length is the same as dropping shorter matches.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "owned")
#: Candidates beyond the base: long runs with digits and letters of both cases.
WIDE = r"[A-Za-z0-9+/_=-]{20,}"
#: A value of more owners was copied.
OWNERS = 2
#: So was one in more repositories than these, and than this share of its owners' repositories.
REPOSITORIES, SHARE = 100, 0.001
#: Matches of a text whose places are summed up together: an array that grows is copied at each step, so it has to stay short.
RUN = 256


def _spans(text: Column, pattern: str, kind: int, values: Column | None = None) -> Column:
    """(start, kind, end, value) of all matches, in code points.

    A split by the pattern gives what lies between the same matches, so their
    places are running sums of lengths: over runs of ``RUN`` matches first, then within each.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if values is None else values
    pairs = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.greatest(F.size(matches), F.lit(1))), F.arrays_zip(matches.alias("m"), values.alias("v")), lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["m"]).alias("n"), m["v"].alias("v")))
    kinds = "array<struct<start:int,kind:int,end:int,value:string>>"

    def cut(whole):
        return F.transform(F.sequence(F.lit(0), (F.size(whole) - 1).cast("int"), F.lit(RUN)), lambda at: F.slice(whole, at + 1, RUN))

    def begun(runs):
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        total = lambda run: F.aggregate(run, F.lit(0), lambda n, p: n + p["gap"] + p["n"])
        return F.aggregate(runs, start, lambda done, run: F.struct((done["at"] + total(run)).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out")), lambda done: done["out"])

    def step(done, p):
        start = done["at"] + p["gap"]
        end = start + p["n"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), p["v"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    def placed(runs):
        begin = lambda at: F.struct(at.alias("at"), F.array().cast(kinds).alias("out"))
        return F.flatten(F.zip_with(runs, begun(runs), lambda run, at: F.aggregate(run, begin(at), step, lambda done: done["out"])))

    # an array of one element binds what is computed, so that it is computed once
    bound = lambda x, f: F.element_at(F.transform(F.array(x), f), 1)
    found = bound(bound(pairs, cut), placed)
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(kinds))


def _listed(spans: Column) -> Column:
    """kind:start:end of each span, by start, then kind, comma-joined."""
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def scan(docs: DataFrame, owners: int = OWNERS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_copied, n_owned) for each row of ``docs``.

    ``docs`` has doc_id, text and source (the owner; null is one owner); other columns are
    ignored. Null and empty texts have no span. ``n_copied`` and ``n_owned`` count the spans
    whose value was copied, which has more owners than ``owners`` or very many repositories, or not.
    Repeated rows are judged each for itself; a text of many matches takes time in proportion to them;
    an empty table gives none.
    """
    text = F.coalesce("text", F.lit(""))
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = F.filter(_spans(text, ASSIGN, 0, values), lambda s: F.length(s["value"]) >= ASSIGN_LEAST)
    live = lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), assign.alias("assign"), _spans(text, ACCESS, 1).alias("access"), _spans(text, HEX, 2).alias("hex"), F.filter(_spans(text, WIDE, 3), live).alias("wide"))
    rows = rows.withColumn("base", F.concat("assign", "access", "hex")).withColumn("row", F.monotonically_increasing_id())
    rows = staged(rows, "secrets")

    # candidates that no base span covers: none that begins at or before them ends behind their start, none begins before their end
    spans = rows.select("row", "doc_id", "source", F.explode(F.concat("base", "wide")).alias("s"))
    order, known = ["s.start", "s.kind", "s.end"], F.col("s.kind") < KINDS.index("owned")
    since, until = Window.partitionBy("row").orderBy(*order), Window.partitionBy("row").orderBy(*map(F.desc, order))
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = spans.withColumn("_end", F.max(F.when(known, F.col("s.end"))).over(upto(since)))
    spans = spans.withColumn("_start", F.min(F.when(known, F.col("s.start"))).over(upto(until)))
    apart = (F.coalesce("_end", F.lit(0)) <= F.col("s.start")) & (F.col("_start").isNull() | (F.col("_start") >= F.col("s.end")))
    spans = spans.filter(known | apart).drop("_end", "_start").withColumn("hash", F.sha2("s.value", 256))

    # owners and repositories of each value; a repository counts once for a value, however many rows it has
    held = spans.groupBy("hash", "source", "doc_id").agg(F.lit(1).alias("one"))
    held = held.groupBy("hash", "source").agg(F.count("*").alias("repositories"))
    sizes = rows.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("all"))
    held = held.join(small(staged(sizes, "sizes")), F.col("source").eqNullSafe(F.col("_source")))
    held = held.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("all").alias("all"))
    held = small(staged(held, "owners"))
    judged = spans.join(held, "hash").withColumn("copied", (F.col("owners") > owners) | (F.col("repositories") > F.greatest(F.lit(REPOSITORIES), F.col("all") * SHARE)))
    added = F.filter(F.collect_list(F.when((F.col("s.kind") == 3) & ~F.col("copied"), F.struct("s.start", "s.kind", "s.end", "s.value"))), lambda s: s.isNotNull())
    judged = judged.groupBy("row").agg(F.sum(F.col("copied").cast("long")).alias("n_copied"), F.sum((~F.col("copied")).cast("long")).alias("n_owned"), added.alias("added"))
    out = rows.join(small(staged(judged, "judged")), "row", "left")
    every = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added"))
    n = lambda c: F.size(c).cast("long").alias(f"n_{c}")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(every).alias("spans"), zero("n_copied"), zero("n_owned"))
