"""Secret scans: pattern kinds, and a randomness test battery with false-discovery control. DataFrame functions only."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_frame

#: Fixed patterns: kind, pattern, group whose length counts, least length.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run of 24 or more is found whole, as shorter runs fail
#: Runs that could be an encoded random value.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
#: Alphabets in the order in which they are tried; a candidate's encoding is the first that holds all its characters.
ALPHABETS = (("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"), ("base36", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"))
#: p-values are binned by their logarithm, so many steps to a power of ten, before ranks are counted; beyond the last step they are one.
GRID, LAST = 50, 1_000
#: What runs of text are taken to be like at most (the null hypothesis): the chance that two symbols are equal is that of letters in prose or twice the alphabet's,
#: a third moment of the same law, the share of neighbours of different kinds (lower, upper, digit, sign), and the correlation of neighbours.
COINCIDENCE, SKEW, CHANGES, CORRELATION = 0.065, 1.3, 0.25, 0.3
#: Elements whose running sum is formed at once.
STRETCH = 256


def bound(value: Column, f) -> Column:
    """f of a value that is worked out once: a variable of a lambda is, an expression repeated inside of one is not."""
    return F.transform(F.array(value), f)[0]


def running(xs: Column, joined_by=lambda a, b: a + b) -> Column:
    """What an associative operation makes of each beginning of an array of ints: first within stretches, then over their totals, so that long arrays aren't copied at each step."""
    zero = F.array().cast("array<int>")
    add = lambda acc, x: F.concat(acc, F.array(F.when(F.size(acc) > 0, joined_by(F.try_element_at(acc, F.lit(-1)), x)).otherwise(x)))

    def whole(s: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / STRETCH).cast("int")), lambda i: F.aggregate(F.slice(s, i * STRETCH + 1, STRETCH), zero, add))
        totals = lambda p: F.aggregate(F.transform(p, lambda q: F.element_at(q, -1)), zero, add)
        shifted = lambda p, t: F.zip_with(p, F.concat(F.array(F.lit(None).cast("int")), F.slice(t, 1, F.size(t) - 1)), lambda q, o: F.when(o.isNull(), q).otherwise(F.transform(q, lambda v: joined_by(o, v))))
        return bound(pieces, lambda p: bound(totals(p), lambda t: F.flatten(shifted(p, t))))

    return F.when(F.size(xs) > 0, bound(xs, whole)).otherwise(zero)


def spans_of(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """array<struct<start,kind_no,kind,end,value>> of the leftmost non-overlapping matches, in code points; null when there is none.

    The pieces between matches and the matches themselves alternate, so that running lengths give the positions.
    """
    order = {"assign": 0, "access": 1, "hex": 2, "random": 3}[kind]
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits

    def placed(s: Column) -> Column:
        ends = running(F.zip_with(F.slice(s["gaps"], 1, F.size(s["hits"])), s["hits"], lambda g, h: F.length(g) + F.length(h)))
        spans = F.zip_with(ends, s["hits"], lambda e, h: F.struct((e - F.length(h)).alias("start"), F.lit(order).alias("kind_no"), F.lit(kind).alias("kind"), e.alias("end"), h.alias("value")))
        if not least:
            return spans
        return F.transform(F.filter(F.zip_with(spans, s["counted"], lambda x, c: F.struct(x.alias("span"), (F.length(c) >= least).alias("fits"))), lambda x: x["fits"]), lambda x: x["span"])

    return F.when(text.rlike(pattern), bound(F.struct(F.split(text, pattern, -1).alias("gaps"), hits.alias("hits"), counted.alias("counted")), placed))


def normal_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal law (Abramowitz and Stegun 26.2.17, error below 1e-7)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def battery(value: Column) -> Column:
    """struct<encoding,n,p>: p is the chance that a run of text looks at least as random as the value does.

    Three tests, each against the null hypothesis that the value is text and for a uniformly random string of the inferred encoding: chi-squared against the
    uniform alphabet (as the number of equal pairs, which it is linear in), runs of symbols of one kind, and lag-one serial correlation of the
    symbols' places in the alphabet. They are joined by Rueger's rule, 3/2 of the second least p-value, which holds whatever their dependence. A short value
    can't be told from text with certainty, so that its p is large however random it looks.
    """
    body = F.rtrim(value, F.lit("="))
    named = [F.when(~body.rlike(f"[^{chars.replace('-', '')}{'-' if '-' in chars else ''}]"), F.struct(F.lit(name).alias("name"), F.lit(chars).alias("chars"))) for name, chars in ALPHABETS]
    coding = F.coalesce(*named, F.struct(F.lit("other").alias("name"), F.lit(ALPHABETS[-1][1]).alias("chars")))
    symbols = bound(F.struct(coding.alias("coding"), F.split(body, "").alias("letters")), lambda s: F.struct(
        s["coding"]["name"].alias("name"), F.length(s["coding"]["chars"]).cast("double").alias("k"),
        F.transform(F.filter(s["letters"], lambda c: c != ""), lambda c: F.instr(s["coding"]["chars"], c)).alias("x"),
        F.transform(F.filter(s["letters"], lambda c: c != ""), lambda c: F.when(c.between("a", "z"), 0).when(c.between("A", "Z"), 1).when(c.between("0", "9"), 2).otherwise(3)).alias("kinds"),
    ))
    return bound(symbols, tests)


def tests(s: Column) -> Column:
    x, k = s["x"], s["k"]
    n = F.size(x).cast("double")
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, b: a + b)
    pairs = F.sequence(F.lit(1), F.greatest(F.size(x) - 1, F.lit(1)))

    chance = F.greatest(F.lit(COINCIDENCE), 2 / k)
    equal = total(F.transform(F.sequence(F.lit(1), k.cast("int")), lambda j: F.size(F.filter(x, lambda v: v == j)).cast("double") * (F.size(F.filter(x, lambda v: v == j)) - 1) / 2))
    mean = n * (n - 1) / 2 * chance
    sd = F.sqrt(mean * (1 - chance) + n * (n - 1) * (n - 2) * chance * chance * (SKEW - 1))
    p_equal = normal_tail((mean - equal - 0.5) / sd)

    changes = total(F.transform(pairs, lambda i: F.when(F.try_element_at(s["kinds"], i + 1) != F.element_at(s["kinds"], i), 1.0).otherwise(0.0)))
    p_runs = normal_tail((changes - 0.5 - (n - 1) * CHANGES) / F.sqrt((n - 1) * CHANGES * (1 - CHANGES)))

    middle = total(F.transform(x, lambda v: v.cast("double"))) / n
    around = F.transform(x, lambda v: v - middle)
    lag = bound(around, lambda d: F.struct(total(F.transform(d, lambda v: v * v)).alias("var"), total(F.transform(pairs, lambda i: F.coalesce(F.try_element_at(d, i + 1), F.lit(0.0)) * F.element_at(d, i))).alias("cov")))
    p_lag = bound(lag, lambda l: F.when(l["var"] > 0, normal_tail((CORRELATION - F.abs(l["cov"] / l["var"])) * F.sqrt(n))).otherwise(1.0))

    p = F.array_sort(F.array(p_equal, p_runs, p_lag))[1] * 1.5
    return F.struct(s["name"].alias("encoding"), F.size(x).alias("n"), F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-300)).alias("p"))


def stratum(n: Column) -> Column:
    """Length classes 20-23, 24-31, 32-47, 48 and more: short strings have less power and are ranked among themselves."""
    return F.when(n < 24, 0).when(n < 32, 1).when(n < 48, 2).otherwise(3)


def scan(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """doc_id, base and random of every row of docs (doc_id, text).

    base: spans of the pattern kinds assign, access and hex; random: runs of 20 and more characters outside the base spans that the battery tells from text.
    False discoveries among those reported are held to `rate` by Benjamini and Hochberg's procedure within each class of encoding and length, as short runs
    have less power and would else be reported on the strength of long ones. Ranks are counted over all candidates of docs: p-values are rounded up to
    a logarithmic grid, and the counts by class and step, at most 5 * 4 * LAST rows, make the thresholds. The text is read once; what is kept
    between the two steps are spans.

    Null text is taken as empty; empty text has no spans; repeated rows each give a row and each count in the ranks; no
    rows give no rows; other columns, whatever their names, are not looked at.
    """
    text = F.coalesce("text", F.lit(""))
    base = F.array_sort(F.concat(*[F.coalesce(x, F.array()) for x in (spans_of(text, ASSIGN, "assign", 2, 6), spans_of(text, ACCESS, "access", 0, 20), spans_of(text, HEX, "hex"))]))
    found = docs.select("doc_id", base.alias("base"), F.coalesce(spans_of(text, CANDIDATE, "random"), F.array()).alias("loose"))
    free = F.when((F.size("base") == 0) | (F.size("loose") == 0), F.col("loose")).otherwise(disjoint(F.col("base"), F.col("loose")))
    tested = F.transform(free, lambda c: F.struct(c["start"].alias("start"), c["kind_no"].alias("kind_no"), c["kind"].alias("kind"), c["end"].alias("end"), battery(c["value"]).alias("test")))
    kept = materialize(found.select("doc_id", F.transform("base", lambda b: F.struct(b["start"], b["kind_no"], b["kind"], b["end"])).alias("base"), tested.alias("loose")), "secret-spans")
    step = lambda p: F.least(F.floor(-F.log10(p) * GRID), F.lit(LAST)).cast("int")
    counts = (
        kept.where(F.size("loose") > 0).select(F.explode("loose").alias("c"))
        .groupBy(F.col("c.test.encoding").alias("encoding"), stratum(F.col("c.test.n")).alias("class"), step(F.col("c.test.p")).alias("step"))
        .count()
        .collect()
    )
    limits = thresholds([(r.encoding, r["class"], r.step, r["count"]) for r in counts], rate)
    if limits:
        cut = F.create_map(*[x for (e, c), limit in sorted(limits.items()) for x in (F.lit(f"{e}:{c}"), F.lit(limit))])
    else:
        cut = F.create_map(F.lit(""), F.lit(LAST + 1))
    passes = lambda c: step(c["test"]["p"]) >= F.coalesce(F.try_element_at(cut, F.concat_ws(":", c["test"]["encoding"], stratum(c["test"]["n"]).cast("string"))), F.lit(LAST + 1))
    plain = lambda c: F.struct(c["start"], c["kind_no"], c["kind"], c["end"])
    return kept.select("doc_id", "base", F.transform(F.filter("loose", passes), plain).alias("random"))


def disjoint(base: Column, loose: Column) -> Column:
    """The spans of loose, of which none overlap, that no span of base meets: no base span begun before one reaches into it, and the next one begins after it."""

    def free(both: Column) -> Column:
        far = 1 << 30
        reach = running(F.transform(both, lambda x: F.when(x["kind_no"] == 3, 0).otherwise(x["end"])), F.greatest)
        following = F.reverse(running(F.transform(F.reverse(both), lambda x: F.when(x["kind_no"] == 3, far).otherwise(x["start"])), F.least))
        near = F.zip_with(F.zip_with(reach, following, lambda r, f: F.struct(r.alias("reach"), f.alias("next"))), both, lambda n, x: F.struct(x.alias("span"), n.alias("near")))
        kept = F.filter(near, lambda x: (x["span"]["kind_no"] == 3) & (x["near"]["reach"] <= x["span"]["start"]) & (x["near"]["next"] >= x["span"]["end"]))
        return F.transform(kept, lambda x: x["span"])

    return bound(F.array_sort(F.concat(base, loose)), free)


def thresholds(counts: list[tuple], rate: float) -> dict[tuple, int]:
    """Of each class (encoding, length) the least step that is reported; counts: encoding, length class, step, number. None is reported of classes without one."""
    out: dict[tuple, int] = {}
    for key in {(e, c) for e, c, _, _ in counts}:
        rows = sorted(((s, n) for e, c, s, n in counts if (e, c) == key), reverse=True)
        all_, seen = sum(n for _, n in rows), 0
        for s, n in rows:
            seen += n
            if 10 ** (-s / GRID) <= rate * seen / all_:
                out[key] = s
    return out


def digest(found: DataFrame) -> DataFrame:
    """The spans of `scan` as counts and text."""
    joined = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", "random")).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )
