"""Secret scans: spans of credentials, and weak parts that count only beside their complements.

Strong kinds are reported wherever they stand: ``assign`` (a keyword and its value), ``access`` (an access identifier) and
``hex`` (a long run of hex digits). Weak kinds are parts of multipart credentials: ``key`` (a run of 20 or more
letters, digits and ``+/_-``, padding included, that looks random: see ``_random``), ``user`` (a client or user identifier) and ``host`` (an endpoint).
A weak part is reported only if a complementary part stands within ``reach`` characters inside the same scope; a scope is a
run of lines with no two empty lines in a row between them, so parts of one block of settings are linked across a single one. Complements: a key needs an access identifier, a user or a host; a user
and a host need a key. A run that is an access identifier, a user or a host itself is no key; one that starts in such a part
and goes on behind it is judged by what follows.

Linking is an interval join. Parts are cut into bins of ``reach`` characters per row and scope; per bin and kind only the
outermost places are kept, so a part meets three bins of at most one row per kind however many parts a text has. Starts
within one bin are always in reach.

NULL text counts as empty: no spans. Positions are code points, ends are exclusive. Whole texts; nothing is capped.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.texts import add_from_text, free_name, quoted
from courtside.session import materialize

# Fixed values of the base scan: patterns and least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ["assign", "access", "hex"]

# Weak parts.
WEAK_KEY = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_=-])"
LEAST_KEY = 20
#: bits a character of a key, and the unbroken piece that a key without both letter cases has
LEAST_BITS = 3.0
LEAST_PIECE = 16
WEAK_USER = r"(?:client|user|account|tenant)_?(?:id|name)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@._-]{3,})"
WEAK_HOST = r"(?:endpoint|host|server|base_?url)[\"']?\x20*[:=]\x20*[\"']?((?:https?://)?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
WEAK = ["key", "user", "host"]
#: which parts confirm a weak part
COMPLEMENTS = {"key": ["access", "user", "host"], "user": ["key"], "host": ["key"]}
REACH = 400
#: what ends a scope: two empty lines or more
GAP = r"\n(?:[ \t\r]*\n){2}"
PLACEHOLDER = "[secret]"

SPAN = T.StructType([
    T.StructField("kind", T.StringType(), False), T.StructField("start", T.LongType(), False),
    T.StructField("end", T.LongType(), False), T.StructField("scope", T.LongType(), False),
])
FOUND = T.StructType([
    T.StructField("strong", T.ArrayType(SPAN, False), False), T.StructField("weak", T.ArrayType(SPAN, False), False),
])


def _finder():
    assign = re.compile(ASSIGN, re.I | re.A).finditer
    access, hexes = re.compile(ACCESS).finditer, re.compile(HEX[:-1] + "{%d,}" % LEAST["hex"]).finditer
    key, user, host = (re.compile(p, re.I | re.A).finditer for p in (WEAK_KEY, WEAK_USER, WEAK_HOST))
    gap = re.compile(GAP).finditer

    def found(text: str) -> tuple[list, list]:
        lower = text.lower()
        strong, weak = [], []
        # the length test of hex is part of its pattern: a run is a run whatever its length
        if any(w in lower for w in ASSIGN_WORDS):
            strong += [("assign", *m.span()) for m in assign(text) if len(m[2]) >= LEAST["assign"]]
        if "AKIA" in text:
            strong += [("access", *m.span()) for m in access(text) if m.end() - m.start() >= LEAST["access"]]
        strong += [("hex", *m.span()) for m in hexes(text)]
        keys = [m.span() for m in key(text) if _random(m[0])]
        if keys:
            parts = [("user", *m.span(1)) for m in user(text)] + [("host", *m.span(1)) for m in host(text)]
            keys = _beside(text, keys, [s for s in strong if s[0] == "access"] + parts)
        if keys:
            weak += [("key", *s) for s in keys] + parts
        if not weak:
            return [{"kind": k, "start": a, "end": b, "scope": 0} for k, a, b in strong], []
        borders = [m.start() for m in gap(text)]

        def rows(spans):
            return [{"kind": k, "start": a, "end": b, "scope": bisect_left(borders, a)} for k, a, b in spans]

        return rows(strong), rows(weak)

    return found


def _random(run: str) -> bool:
    """Digits and both letter cases, or digits and letters with a long piece unbroken by ``+/_-``; and many different characters,
    unless it has the exact shape of a 40 character key."""
    body = run.rstrip("=")
    upper, lower = any(c.isupper() for c in body), any(c.islower() for c in body)
    if not any(c.isdigit() for c in body) or not (upper or lower):
        return False
    if upper and lower and len(run) == 40 and not set(run) & set("=_-"):
        return True
    if not (upper and lower) and max(map(len, re.split("[+/_-]", body))) < LEAST_PIECE:
        return False
    return -sum(n / len(body) * math.log2(n / len(body)) for n in Counter(body).values()) >= LEAST_BITS


def _beside(text: str, keys: list[tuple[int, int]], parts: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Of keys in ascending order, what no other part covers: those that start in a part are cut at its end and judged again."""
    borders = sorted((a, b) for _, a, b in parts)
    # the furthest end of the parts that start up to each one
    ends = list(accumulate((b for _, b in borders), max))
    out = []
    for a, b in keys:
        k = bisect_right(borders, (a, len(text)))
        start = max(a, ends[k - 1]) if k else a
        if start == a or b - start >= LEAST_KEY and _random(text[start:b]):
            out.append((start, b))
    return out


def candidates(df: DataFrame, text: str, into: str, keep: list[str] | None = None) -> DataFrame:
    """Adds the strong and the weak spans of each text. Users and hosts are only looked for beside a key: nothing else
    confirms them, and they confirm nothing but keys."""

    def make():
        found = _finder()

        def work(texts):
            both = [found(t) for t in texts]
            return [[s for s, _ in both], [w for _, w in both]]

        return work

    return add_from_text(df, text, make, into, FOUND, keep)


def link(parts: DataFrame, key: list[str], reach: int = REACH) -> DataFrame:
    """Of parts (``key`` columns, kind, start, end, scope), the weak ones with a complement in reach in their scope."""
    binned = parts.withColumn("bin", F.floor(F.col("start") / reach))
    # one row per bin and kind: its outermost starts decide for both neighbours
    edges = binned.groupBy(*key, "scope", "bin", "kind").agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
    near = edges.select(*key, "scope", F.col("kind").alias("other"), F.col("bin").alias("from"), "lo", "hi",
                        F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"))
    weak = binned.filter(F.col("kind").isin(WEAK))
    pairs = [(k, o) for k, others in COMPLEMENTS.items() for o in others]
    fits = F.lit(False)
    for kind, other in pairs:
        fits = fits | ((F.col("kind") == kind) & (F.col("other") == other))
    w, n = weak.alias("w"), near.alias("n")
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"n.{c}")) for c in [*key, "scope", "bin"]]
    in_reach = (
        (F.col("n.from") == F.col("w.bin"))
        | ((F.col("n.from") < F.col("w.bin")) & (F.col("w.start") - F.col("n.hi") <= reach))
        | ((F.col("n.from") > F.col("w.bin")) & (F.col("n.lo") - F.col("w.start") <= reach))
    )
    on = in_reach & fits
    for s in same:
        on = on & s
    return w.join(n, on, "left_semi").select(*key, "kind", "start", "end")


def scan(df: DataFrame, text: str = "text", into: str = "found", keep: list[str] | None = None, reach: int = REACH) -> DataFrame:
    """``df`` (or its columns ``keep``) with a struct of span arrays: ``strong`` and the confirmed ``linked`` ones.

    Repeated rows and NULL keys are no trouble: spans belong to a text, so texts are linked by their digest.
    """
    names = df.columns if keep is None else keep
    digest = free_name(df, "_text_digest")
    found = candidates(df.withColumn(digest, F.md5(F.coalesce(quoted(text), F.lit("")))), text, into, [*names, digest])
    found = materialize(found, "spans")
    # equal texts have equal spans: one of them is linked
    weak = (found.filter(F.size(f"{into}.weak") > 0)
            .select(F.col(digest).alias("digest"), F.col(f"{into}.strong").alias("s"), F.col(f"{into}.weak").alias("w"))
            .dropDuplicates(["digest"])
            .select("digest", F.explode(F.concat(F.filter("s", lambda x: x["kind"] == "access"), "w")).alias("p"))
            .select("digest", "p.*"))
    # written, so that the join below deals both of its sides itself and can split a digest that many copies share
    linked = materialize(link(weak, ["digest"], reach).groupBy("digest").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "kind"))).alias("linked")), "linked")
    of, more = free_name(found, "_linked_digest"), free_name(found, "_linked")
    linked = linked.toDF(of, more)
    open_rows = found.filter(F.size(f"{into}.weak") > 0)
    confirmed = open_rows.join(linked, F.col(digest) == F.col(of), "left")
    plain = lambda a: F.transform(a, lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")

    def result(rows: DataFrame, spans: Column) -> DataFrame:
        return rows.select(*[quoted(c) for c in names], F.struct(
            plain(F.col(f"{into}.strong")).alias("strong"), spans.alias("linked")).alias(into))

    return result(found.filter(F.size(f"{into}.weak") == 0), none).unionByName(
        result(confirmed, F.coalesce(plain(F.col(more)), none)))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind in the order listed, comma-joined."""
    order = F.create_map(*[x for i, k in enumerate(KINDS + WEAK) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), F.element_at(order, x["kind"]).alias("k"), x["end"].alias("end"), x["kind"].alias("kind")))
    return F.array_join(F.transform(F.sort_array(keyed), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(df: DataFrame, spans: str, text: str = "text", placeholder: str = PLACEHOLDER) -> DataFrame:
    """``df`` with every span of the array column ``spans`` replaced in its text; overlapping spans are one. Rows without
    spans are left as they are, a NULL text stays NULL."""
    ordered = F.sort_array(F.transform(quoted(spans), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    value = quoted(text)
    step = lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
        s["end"].alias("at"),
        F.array_append(acc["parts"], F.when(s["start"] < acc["at"], F.lit("")).otherwise(F.concat(
            F.substring(value, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(placeholder))))
        .alias("parts")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    whole = F.aggregate(ordered, start, step, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(value, (acc["at"] + 1).cast("int"), F.length(value))))
    return df.withColumn(text, F.when(F.size(quoted(spans)) > 0, whole).otherwise(value))
