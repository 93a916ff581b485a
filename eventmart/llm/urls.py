"""Operator 7: URL filter by a ratio of character language models, with DataFrame functions only.

Two Markov models of variable order, one of accepted and one of rejected URLs, are learned from
the URLs that the rules decide. The probability of a character interpolates all orders:
p_k = (n(context, char) + STRENGTH * p_(k-1)) / (n(context) + STRENGTH), from a uniform p_0.
A URL's score is the log-likelihood difference per character, and the threshold is
calibrated on URLs that were held out of the models. What is scored is the whole URL, its host in
lower case: scheme, host, path, query and fragment.

All counts are of grams: every URL is exploded to its grams of ORDER characters, and
summing them by gram is map-side. Shorter grams are suffixes of those, so they are
summed from the table of distinct grams, and each distinct gram is scored once.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import small, staged

#: Characters of a gram: a character and its longest context.
ORDER = 5
STRENGTH = 2.0
#: Characters of the uniform distribution.
ALPHABET = 256
START, END = "\u0002", "\u0003"
#: Scores are calibrated in steps, between bounds.
STEP, BOUND = 0.01, 10.0

#: (verdict, host, path) of each rule.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; path: from there to "?", "#" or the end."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), path


def whole(url: Column) -> Column:
    """The text that is scored: the URL with its host in lower case; as it is without "://"; empty if null."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    lead = F.substr(url, F.lit(1), at + 2)
    rest = F.substr(url, at + 3)
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lower = F.concat(lead, F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), F.substr(rest, F.length(raw) + 1))
    return F.coalesce(F.when(at > 0, lower).otherwise(url), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits the host or a domain above it, and the beginning of the path; a struct, or null."""
    fits = []
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fit = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        fits.append(F.when(fit, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits)


def _grams(text: Column) -> Column:
    """The grams that end at the start of the text, at each of its characters and at its end."""
    padded = F.concat(F.lit(START * ORDER), text, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 2), lambda i: F.substr(padded, i, F.lit(ORDER)))


def gram_scores(urls: DataFrame) -> DataFrame:
    """(gram, ratio): the log of the ratio of probabilities of each gram's last character.

    ``urls`` has ``text`` and ``label``: 1 accepted, 0 rejected, null for neither. Grams of
    all URLs are scored, those of labelled URLs are counted.
    """
    rows = urls.select(F.explode(_grams(F.col("text"))).alias("gram"), "label")
    one = lambda label: F.sum((F.coalesce(F.col("label"), F.lit(-1)) == label).cast("long"))
    grams = staged(rows.groupBy("gram").agg(one(1).alias("good"), one(0).alias("bad")), "grams")
    # every suffix of a gram, with its counts; as a context, it is followed by one character
    suffixes = F.explode(F.transform(F.sequence(F.lit(1), F.lit(ORDER)), lambda k: F.substr("gram", ORDER - k + 1)))
    counts = grams.filter("good + bad > 0").select(suffixes.alias("key"), "good", "bad").groupBy("key").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    counts = staged(counts, "counts")
    total = grams.filter(~F.col("gram").endswith(START)).agg(F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()

    need = [(k, F.substr("gram", F.lit(ORDER - k + 1))) for k in range(1, ORDER + 1)]
    need += [(-k, F.substr("gram", F.lit(ORDER - k + 1), F.lit(k - 1))) for k in range(2, ORDER + 1)]
    asked = grams.filter(~F.col("gram").endswith(START)).select("gram", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), key.alias("key")) for k, key in need))).alias("x"))
    found = asked.select("gram", "x.k", "x.key").join(small(counts), "key", "left")
    value = lambda k, n: F.coalesce(F.max(F.when(F.col("k") == k, F.col(n))), F.lit(0)).alias(f"{n}_{k}".replace("-", "c"))
    wide = found.groupBy("gram").agg(*(value(k, n) for k, _ in need for n in ("n_good", "n_bad")))
    logs = []
    for n, size in (("n_good", total[0]), ("n_bad", total[1])):
        p = F.lit(1.0 / ALPHABET)
        for k in range(1, ORDER + 1):
            context = F.lit(size) if k == 1 else F.col(f"{n}_c{k}")
            p = (F.col(f"{n}_{k}") + STRENGTH * p) / (context + STRENGTH)
        logs.append(F.log(p))
    return staged(wide.select("gram", (logs[0] - logs[1]).alias("ratio")), "scores")


def calibrated(scored: DataFrame) -> float:
    """The threshold with the best mean of the shares of accepted and rejected URLs it gets right; 0 if one kind is missing.

    ``scored`` has score and label. Scores are counted in steps, so what is collected is
    bounded. Among equal thresholds the one nearest 0 counts.
    """
    step = F.round(F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), F.col("score"))) / STEP).cast("long")
    rows = scored.filter("label is not null").groupBy(step.alias("step")).agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")).collect()
    good, bad = sum(r.good for r in rows), sum(r.bad for r in rows)
    if not good or not bad:
        return 0.0
    best, below_good, below_bad = (0.5, 0.0, 0.0), 0, 0
    for r in sorted(rows):
        # the threshold lies at the lower edge of this step
        at = (r.step - 0.5) * STEP
        best = max(best, (((good - below_good) / good + below_bad / bad) / 2, -abs(at), at))
        below_good, below_bad = below_good + r.good, below_bad + r.bad
    return best[2]


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for each row of ``pages`` (page_id, url; others are ignored).

    A URL that is null or has no "://" has an empty host and path, and no rule fits it; its
    text is scored as it is, a null one as the empty text. A verdict is the longest fitting rule's, else allow
    from the threshold on. Repeated rows have a row each; equal URLs are scored once. A very long URL
    makes as many grams as it has characters. An empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), whole(F.col("url")).alias("text"))
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    # equal texts are scored once; their fold is a hash of the text
    label = (F.col("fit.verdict") == "allow").cast("int")
    held = F.crc32(F.col("text").cast("binary")) % 5 == 0
    rows = rows.withColumn("label", label).withColumn("held", held)
    ratios = gram_scores(rows.select("text", F.when(~F.col("held"), F.col("label")).alias("label")))
    texts = rows.groupBy("text").agg(F.max("label").alias("label"), F.max("held").alias("held"))
    grams = texts.select("text", "label", "held", F.explode(F.slice(_grams(F.col("text")), 2, 1 << 30)).alias("gram"))
    scored = grams.join(small(ratios), "gram").groupBy("text", "label", "held").agg(F.avg("ratio").alias("score"))
    scored = staged(scored, "urls")
    threshold = calibrated(scored.filter("held"))
    scored = scored.select(F.col("text").alias("_text"), "score")
    out = rows.join(small(scored), F.col("text") == F.col("_text"), "left")
    verdict = F.coalesce("fit.verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return out.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "score")
