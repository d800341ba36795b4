"""PII by fixed patterns and bootstrapped contextual extraction.

Base spans (email, ip, card, phone) are the seeds. The two words before an instance are its
lexical pattern. Unseen identifiers that no base span touches are instances without a kind: tokens with
a digit, digit groups joined by blanks, dots, hyphens or brackets (one instance), and address forms
with @, (at) or "at ... dot", digits or not. Spark scores the graph of patterns and instances round by
round: a pattern's confidence for a kind is the mean confidence of its distinct instances that could
be of that kind (``SHAPES``), an instance takes the best confidence among its patterns with enough
support. After ``ROUNDS`` rounds, identifiers of confidence ``CONFIDENT`` become spans of that kind.

One Python pass reads the texts; everything after it is joins and partial aggregates over narrow rows,
so the graph is never gathered and hot patterns are pre-aggregated.

Defined cases: null text is empty; rows equal in id and text share their spans; base spans of different
kinds may overlap; an instance without a word before it has no pattern, but becomes a span if the same
identifier is known from elsewhere; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import materialise

# fixed values: the base patterns
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
# the same matches in one pass over any text: an address is found by its host and grows to the left from there, an ip
# starts where a run of digits does (a later start in the run fails alike), groups never give digits back
HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
NAME = re.compile(r"[A-Za-z0-9._%+-]*+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(PATTERNS["phone"])
TOKEN = re.compile(r"[A-Za-z0-9@._+()-]++")        # with a digit in it
DIGIT = re.compile(r"[0-9]")
NUMBER = re.compile(r"[+(]{0,2}[0-9][0-9().-]*")       # a token that can be a group of a longer number
JOIN = re.compile(r"\x20{1,2}|\x20[.-]\x20|[.-]?\(|\)\x20?")
GROUPED = range(7, 20)                                  # digits of a number written in groups
WHOLE = 9                                               # digits from which a group is a number of its own
_NAME, _HOST = r"[\w%+-]++(?:\.[\w%+-]++)*+", r"[\w-]++"
_BDOT = r"\x20?[(\[{<]\x20?dot\x20?[)\]}>]\x20?"
ADDRESS = re.compile(
    rf"(?<![\w.%+-]){_NAME}(?:{_BDOT}{_NAME})*(?:(?:@|\x20@\x20|\x20?[(\[{{<]\x20?at\x20?[)\]}}>]\x20?)"
    rf"{_HOST}(?:(?:\.|{_BDOT}|\x20dot\x20){_HOST})*|\x20at\x20{_HOST}(?:(?:\.|{_BDOT}|\x20dot\x20){_HOST})+)", re.IGNORECASE)
ANCHOR = re.compile(r"@|[(\[{<]\x20?at\x20?[)\]}>]|\x20at\x20[\w-]++(?:\.|\x20?[(\[{<]?\x20?dot)", re.IGNORECASE)
# what an identifier holds at least to be of a kind
SHAPES = {"email": r"[\p{L}@]", "ip": "([0-9][^0-9]*){4}", "card": "([0-9][^0-9]*){4}", "phone": "([0-9][^0-9]*){3}"}
CONTEXT = 80          # characters looked at for the words before an instance
ROUNDS = 3
SUPPORT = 3.0
CONFIDENT = 0.8
SCHEMA = ("doc_id long, _h string, base array<struct<kind:string,start:long,end:long>>, "
          "seen array<struct<kind:string,start:long,end:long,token:string,pattern:string>>")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _holds(kind: str, found: str) -> bool:
    if kind == "ip":
        parts = [p.lstrip("0") for p in found.split(".")]
        return all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts)
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    t = text or ""
    found = [("email", a, b) for a, b in _emails(t)]
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(t) if _holds(kind, m.group())]
    return found


def _emails(text: str) -> Iterator[tuple[int, int]]:
    if "@" not in text:
        return
    back, end = text[::-1], 0
    for m in HOST.finditer(text):
        start = len(text) - NAME.match(back, len(text) - m.start()).end()
        start = max(start, end)
        if start < m.start():
            end = m.end()
            yield start, end


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _apart(pattern: re.Pattern, text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Matches that touch none of the taken spans."""
    low = 0
    for a, b in [*sorted(taken), (len(text), len(text))]:
        if a > low:
            for m in pattern.finditer(text, low, a):
                if (m.start() > low or low == 0) and (m.end() < a or a == len(text)):
                    yield m.span()
        low = max(low, b)


def _digits(text: str) -> int:
    return len(re.sub(r"[^0-9]", "", text))


def _cut(widths: list[int]) -> list[int]:
    """Groups of each number in a row of groups: repeats of one form, else as many groups as a number takes."""
    n, most = len(widths), GROUPED[-1]
    if sum(widths) > most:
        for p in range(2, n // 2 + 1):
            if n % p == 0 and widths == widths[:p] * (n // p) and WHOLE <= sum(widths[:p]) <= most:
                return [p] * (n // p)
    out, total = [], most
    for w in widths:
        if total + w > most:
            out.append(0)
            total = 0
        out[-1] += 1
        total += w
    return out


def candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of the identifiers outside the ``taken`` ones."""
    out = list(_apart(ADDRESS, text, taken)) if ANCHOR.search(text) else []
    row: list[tuple[int, int, int]] = []             # neighbouring groups: start, end, digits

    def close() -> None:
        at = 0
        for n in _cut([d for _, _, d in row]):
            part = row[at:at + n]
            at += n
            whole = sum(d for _, _, d in part) in GROUPED
            out.extend([(part[0][0], part[-1][1])] if whole else [(a, b) for a, b, _ in part])
        row.clear()

    for a, b in _apart(TOKEN, text, [*taken, *out]):
        if not DIGIT.search(text, a, b):
            continue
        while text[b - 1] in ".-(" or text[b - 1] == ")" and "(" not in text[a:b]:
            b -= 1
        if not NUMBER.fullmatch(text, a, b):
            close()
            out.append((a, b))
            continue
        d = _digits(text[a:b])
        if row and (d >= WHOLE or row[-1][2] >= WHOLE or text[a] == "+" or not JOIN.fullmatch(text, row[-1][1], a)):
            close()
        row.append((a, b, d))
    close()
    return sorted(out)


def _instances(text: str, base: list[tuple[str, int, int]]) -> list[tuple]:
    rows = []
    for k, a, b in [*base, *((None, *s) for s in candidates(text, [(a, b) for _, a, b in base]))]:
        words = text[max(0, a - CONTEXT):a].split()[-2:]
        pattern = re.sub(r"[0-9]", "0", " ".join(words).lower()) if words else None
        if words or not k:
            rows.append({"kind": k, "start": a, "end": b, "token": text[a:b], "pattern": pattern})
    return rows


def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        texts = [t or "" for t in b["text"]]
        base = [base_spans(t) for t in texts]
        yield pd.DataFrame({
            "doc_id": b["doc_id"], "_h": [hashlib.md5(t.encode()).hexdigest() for t in texts],
            "base": [[{"kind": k, "start": a, "end": e} for k, a, e in x] for x in base],
            "seen": [_instances(t, x) for t, x in zip(texts, base, strict=True)]})


def score_graph(seen: DataFrame, rounds: int = ROUNDS, support: float = SUPPORT) -> DataFrame:
    """(token, kind, conf): confidence of identifiers without a base kind; ``seen`` has kind, token, pattern."""
    edges = materialise(seen.where(F.col("pattern").isNotNull()).groupBy("pattern", "token")
                        .agg(F.max("kind").alias("seed")), "pii-edges")
    could = {k: F.col("seed").isNotNull() | F.col("token").rlike(s) for k, s in SHAPES.items()}
    size = edges.groupBy("pattern").agg(*[F.count_if(c).alias(f"n_{k}") for k, c in could.items()])
    n = F.coalesce(*[F.when(F.col("kind") == k, F.col(f"n_{k}")) for k in KINDS])
    seeds = edges.where(F.col("seed").isNotNull()).select("token", F.col("seed").alias("kind"), F.lit(1.0).alias("conf")).distinct()
    conf = seeds
    for k in range(rounds):
        weight = edges.join(conf, "token").groupBy("pattern", "kind").agg(F.sum("conf").alias("s"))
        good = (weight.join(size, "pattern").where(F.col("s") >= support)
                .select("pattern", "kind", (F.col("s") / n).alias("conf")))
        fits = F.coalesce(*[F.when(F.col("kind") == k, F.col("token").rlike(s)) for k, s in SHAPES.items()])
        new = (edges.where(F.col("seed").isNull()).select("pattern", "token").join(good, "pattern").where(fits)
               .groupBy("token", "kind").agg(F.max("conf").alias("conf")))
        new = materialise(new, f"pii-round{k}")
        conf = seeds.unionByName(new.join(seeds.select("token").distinct(), "token", "left_anti"))
    best = Window.partitionBy("token").orderBy(F.col("conf").desc(), "kind")
    return new.withColumn("_r", F.row_number().over(best)).where(F.col("_r") == 1).drop("_r")


def find(docs: DataFrame, confident: float = CONFIDENT) -> DataFrame:
    """doc_id, base spans, all spans (arrays of kind, start, end in kind and start order)."""
    rows = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                       .mapInPandas(extract, SCHEMA), "pii-rows")
    seen = rows.select("doc_id", "_h", F.explode("seen").alias("s")).select("doc_id", "_h", "s.*")
    known = score_graph(seen).where(F.col("conf") >= confident).select("token", F.col("kind").alias("_kind"))
    more = (seen.where(F.col("kind").isNull()).join(known, "token")
            .groupBy(F.col("doc_id").alias("_id"), F.col("_h").alias("_mh"))
            .agg(F.collect_set(F.struct(F.col("_kind").alias("kind"), "start", "end")).alias("more")))
    out = rows.join(more, rows["doc_id"].eqNullSafe(more["_id"]) & (rows["_h"] == more["_mh"]), "left")
    every = F.concat("base", F.coalesce("more", F.array().cast("array<struct<kind:string,start:long,end:long>>")))
    rank = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.array_sort(F.transform(every, lambda s: F.struct(
        F.array_position(rank, s["kind"]).alias("o"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return out.select("doc_id", "base", F.transform(keyed, lambda s: F.struct(s["kind"], s["start"], s["end"])).alias("spans"))


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is(kind: str):
    return lambda s: s["kind"] == kind


def digest(found: DataFrame) -> DataFrame:
    """The counts, the digest of base spans and all spans as text."""
    n = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *n, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
