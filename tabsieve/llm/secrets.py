"""Secrets in texts, with DataFrame functions only.

Base patterns are reported wherever they match.  Weaker candidates, an identifier, something like a secret, an
endpoint, say little alone; they are linked to each other within a scope, a stretch of a document, and reported only
where their complement stands: an identifier near a secret, a secret near an identifier, an endpoint near both.  The
base matches take part as identifiers and secrets.

The link is an interval join of each candidate with its complements: the gap between two is from the end of the earlier
to the start of the later, so the nearest are the largest end of those that start before and the smallest start of those
behind.  Both are windows over the candidates of a document: it costs a sort, and no pair is listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsieve.llm.common import quoted

SCOPE = 200

_NAME = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key"))

# Base patterns by kind, with the group whose length counts and its least length.
BASE = {
    "assign": (rf"""({_NAME})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": ("(AKIA[A-Z0-9]+)", 1, 16),
    "hex": ("(?<![0-9a-f])([0-9a-f]{32,}+)", 1, 32),
}

# Weak patterns by kind; the first of a kind's names that fits is enough.
WEAK = {
    "identifier": r"""(?i)\b(?:access[_-]?key(?:[_-]?id)?|client[_-]?id|user(?:name)?|login|account(?:[_-]?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""",
    "secret": r"""(?i)\b(?:secret[_-]?(?:access[_-]?)?key|client[_-]?secret|private[_-]?key|pwd|pass|auth(?:orization)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])""",
    "endpoint": r"""(?i)\b(?:https?|jdbc|mongodb|postgres(?:ql)?|mysql|redis|amqp|ftp):[A-Za-z0-9:/?#@!$&*+,;=._~%-]{6,}|\bhost(?:name)?["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}""",
}

#: What each kind is to the others.
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "secret": "secret", "endpoint": "endpoint"}
ORDER = {kind: i for i, kind in enumerate([*BASE, *WEAK])}


def _matches(text: Column, kind: str) -> Column:
    """(kind, matches, characters before each) of one pattern, null without a match."""
    pattern = BASE[kind][0] if kind in BASE else WEAK[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    return F.when(text.rlike(pattern), F.struct(F.lit(kind).alias("kind"), found.alias("found"), gaps.alias("gaps")))


def secret_spans(df: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """(key, content, kind, start, end, base): base spans and linked candidates, in code points, end exclusive.

    content is the md5 of the text: rows of one key and text have their spans once.  Null texts have none.
    """
    rows = df.select(quoted(key).alias("key"), F.md5(F.coalesce(quoted(text), F.lit(""))).alias("content"), quoted(text).cast("string").alias("text"))
    each = rows.select("key", "content", F.explode(F.array_compact(F.array(*(_matches(F.col("text"), kind) for kind in ORDER)))).alias("m"))
    listed = each.select("key", "content", "m.kind", "m.gaps", F.posexplode("m.found").alias("nth", "match"))
    listed = listed.select("key", "content", "kind", "nth", "match", F.get("gaps", F.col("nth")).alias("gap")).dropDuplicates(["key", "content", "kind", "nth"])
    size = F.char_length("match")
    in_order = Window.partitionBy("key", "content", "kind").orderBy("nth")
    placed = listed.withColumn("end", F.sum(F.col("gap") + size).over(in_order)).withColumn("start", F.col("end") - size)
    long_enough = F.coalesce(*(F.when(F.col("kind") == kind, F.char_length(F.regexp_extract("match", pattern, group)) >= least) for kind, (pattern, group, least) in BASE.items()), F.lit(True))
    placed = placed.where(long_enough).select("key", "content", "kind", "start", "end", F.col("kind").isin(*BASE).alias("base"))
    role = F.coalesce(*(F.when(F.col("kind") == kind, F.lit(role)) for kind, role in ROLE.items()))
    of_text = Window.partitionBy("key", "content").orderBy("start")
    before, after = of_text.rangeBetween(Window.unboundedPreceding, 0), of_text.rangeBetween(0, Window.unboundedFollowing)
    seen = placed.withColumn("role", role)

    def near(r: str) -> Column:
        """Whether one of role r ends at most `scope` before the start, or starts at most `scope` behind the end."""
        own = F.col("role") == r
        ahead, behind = F.col("start") - F.max(F.when(own, F.col("end"))).over(before), F.min(F.when(own, F.col("start"))).over(after) - F.col("end")
        return F.coalesce(F.least(ahead, behind) <= scope, F.lit(False))

    seen = seen.select("*", *(near(r).alias(f"near_{r}") for r in ("identifier", "secret")),
                       F.max(F.when(F.col("base"), F.col("end"))).over(before).alias("base_end"), F.min(F.when(F.col("base"), F.col("start"))).over(after).alias("base_start"))
    linked = F.when(F.col("role") == "identifier", F.col("near_secret")).when(F.col("role") == "secret", F.col("near_identifier")).otherwise(F.col("near_identifier") & F.col("near_secret"))
    apart = (F.coalesce("base_end", F.lit(-1)) <= F.col("start")) & (F.col("end") <= F.coalesce("base_start", F.col("end")))
    return seen.where(F.col("base") | (linked & apart)).select("key", "content", "kind", "start", "end", "base")


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def find_secrets(df: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans, n_linked) for every row of df.

    The counts and base_sha256 are of the base spans, spans of all; n_linked counts the linked candidates.  Null and
    empty texts have none; repeated rows each appear, null keys too.
    """
    order = F.coalesce(*(F.when(F.col("kind") == kind, F.lit(i)) for kind, i in ORDER.items()))
    entry = F.struct("start", order.alias("order"), "end", "kind")
    found = secret_spans(df, key, text, scope).groupBy("key", "content").agg(
        *(F.count(F.when(F.col("kind") == kind, 1)).alias(f"n_{kind}") for kind in BASE),
        F.sha2(_joined(F.collect_list(F.when(F.col("base"), entry))), 256).alias("base_sha256"),
        _joined(F.collect_list(entry)).alias("spans"),
        F.count(F.when(~F.col("base"), 1)).alias("n_linked"))
    rows = df.select(quoted(key).alias("key"), F.md5(F.coalesce(quoted(text), F.lit(""))).alias("content"))
    both = rows.alias("r").join(found.alias("f"), F.col("r.key").eqNullSafe(F.col("f.key")) & (F.col("r.content") == F.col("f.content")), "left")
    zero = {"base_sha256": F.sha2(F.lit(""), 256), "spans": F.lit("")}
    names = [*(f"n_{kind}" for kind in BASE), "base_sha256", "spans", "n_linked"]
    return both.select(F.col("r.key").alias(key), *(F.coalesce(F.col(f"f.{n}"), zero.get(n, F.lit(0).cast("long"))).alias(n) for n in names))
