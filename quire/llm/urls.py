"""URL filters: host and path rules, and per-host trees of path templates judged by smoothed labelled purity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize

#: Fixed rules: verdict, host, path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Levels of a template tree; deeper segments form one.
DEPTH = 8
#: Parts into which the pages of one template are dealt when verdicts are joined back.
SALTS = 16


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without '://' or for null."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return ascii_lower(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct<rule,verdict> of the longest rule that fits, null if none does; among equally long ones, block wins."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def shape(path: Column) -> Column:
    """Path segments joined by '/', with numbers and long hexadecimal runs as typed wildcards, at most DEPTH of them."""
    segments = F.filter(F.split(ascii_lower(path), "/"), lambda s: s != "")
    typed = F.transform(segments, lambda s: F.regexp_replace(F.regexp_replace(s, r"[0-9a-f-]{16,}", "{h}"), r"[0-9]+", "{n}"))
    return F.array_join(F.concat(F.slice(typed, 1, DEPTH - 1), F.when(F.size(typed) >= DEPTH, F.array(F.array_join(F.slice(typed, DEPTH, 1 << 30), "|"))).otherwise(F.array().cast("array<string>"))), "/")


def judge(
    pages: DataFrame,
    labelled: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    least: int = 20,
    share: float = 0.02,
    z: float = 2.58,
    strength: float = 10.0,
    purity: float = 0.5,
) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity of every row of pages (page_id, url).

    labelled: page_id and bad (boolean) of some pages. Pages are first counted by host and typed path shape, so that a
    host of any size is a table of shapes. Level by level below each node of a host's tree, a segment with at least `least` pages whose rate of bad labels
    differs from its parent's (a z-test with continuity correction) is a branch of its own, however small its share; of the others, one with under `least`
    pages, or under `share` of its parent's, is variable and becomes '*', and the rest join into one branch '+'. A template's purity is the good share of its
    labels, smoothed by `strength` labels at its host's purity, which is smoothed alike by that of all pages; under
    `purity` it is blocked. A rule that fits decides before any template.

    Null url or one without '://': empty host and path, judged as the template of that host. Null or repeated page_ids:
    each row is judged, and a page_id is bad if any of its labels says so. No labels: nothing is blocked but by rules.
    No rows: no rows. Other columns are not looked at.
    """
    host, path = parts(F.col("url"))
    known = labelled.where(F.col("page_id").isNotNull()).groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path"))
    shaped = seen.select("page_id", "host", shape(F.col("path")).alias("shape"))
    count = [F.sum(c).alias(c) for c in ("n", "labels", "bad")]
    now = materialize(
        shaped.join(known, "page_id", "left")
        .groupBy("host", "shape")
        .agg(F.count("*").alias("n"), F.count("bad").alias("labels"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("segments", F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(F.split("shape", "/")))
        .withColumn("template", F.lit("")),
        "url-shapes",
    )
    levels = now.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(1, levels + 1):
        here = now.withColumn("segment", F.try_element_at("segments", F.lit(level)))
        nodes = here.where(F.col("segment").isNotNull()).groupBy("host", "template", "segment").agg(*count)
        above = nodes.groupBy("host", "template").agg(F.sum("n").alias("all"), F.sum("labels").alias("all_labels"), F.sum("bad").alias("all_bad"))
        rate = (F.col("all_bad") + 1) / (F.col("all_labels") + 2)
        apart = F.abs(F.col("bad") - F.col("labels") * rate) - 0.5 > z * F.sqrt(F.greatest(F.col("labels"), F.lit(1)) * rate * (1 - rate))
        fixed = (
            nodes.where(F.col("n") >= least)
            .join(above, ["host", "template"])
            .where((F.col("n") >= share * F.col("all")) | apart)
            .select("host", "template", "segment", F.when(apart, F.col("segment")).otherwise("+").alias("branch"))
        )
        step = F.when(F.col("segment").isNotNull(), F.concat("template", F.lit("/"), F.coalesce("branch", F.lit("*")))).otherwise(F.col("template"))
        now = materialize(here.join(fixed, ["host", "template", "segment"], "left").withColumn("template", step).drop("segment", "branch"), "url-level")
    everything = now.agg(*count).first()
    prior = 1 - (everything.bad or 0) / everything.labels if everything.labels else 1.0
    smooth = lambda before: (F.col("labels") - F.col("bad") + strength * before) / (F.col("labels") + strength)
    hosts = now.groupBy("host").agg(*count).select("host", smooth(F.lit(prior)).alias("host_purity"))
    templates = now.groupBy("host", "template").agg(*count).join(hosts, "host").select("host", "template", smooth(F.col("host_purity")).alias("purity"))
    verdicts = now.select("host", "template", "shape").join(templates, ["host", "template"])
    verdicts = verdicts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = seen.withColumn("shape", shape(F.col("path"))).withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"))
    rule = ruled(F.col("host"), F.col("path"), rules)
    return (
        salted.join(verdicts, ["host", "shape", "salt"], "left")
        .withColumn("found", rule)
        .select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", F.when(F.col("purity") < purity, "block").otherwise("allow")).alias("verdict"), "template", "purity")
    )


def labels_by_number(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id and bad: the first number in a page's path is the doc_id of the document it shows; low quality and toxicity are bad."""
    _, path = parts(F.col("url"))
    shown = pages.select("page_id", F.try_to_number(F.regexp_extract(path, r"/(\d{1,18})(?:$|[/.])", 1), F.lit("9" * 18)).cast("long").alias("doc_id"))
    return shown.join(labels.where(F.col("doc_id").isNotNull()), "doc_id").select("page_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
