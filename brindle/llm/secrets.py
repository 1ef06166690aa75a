"""Secret scans through a trigram inverted index, in DataFrame operations only.

Each rule's regex is parsed and turned into a Boolean query over trigrams of the lower-cased text: an OR over its
alternatives of ANDs of trigrams in their literal runs, the PER_WAY likely rarest of each. The index holds, per block of documents and
trigram of any query, the postings (document keys). Per block the lists are intersected and united as the queries say; documents left are
candidates of the rule and only they are verified with its regex. A rule with an alternative that has no trigram scans fully.

Keys are hashes of id and text: equal rows share postings, and a collision could only add a candidate, which the regex judges. A bitmap
of candidate keys, of bounded size, keeps all other texts out of the exchange in which candidates meet their rules.

Cases: a null text is empty and has no spans. Texts are searched whole, and a text's time grows with its matches, not their square.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import shuffle_partitions, stage

#: Documents of a block of the index.
BLOCK = 8192
#: Alternatives that a query may have; beyond, literals are forgotten (which only adds candidates).
MOST = 128
#: Trigrams of an alternative that are asked for.
PER_WAY = 2
#: Bits of the bitmap of candidate keys, at most; and of one row of it (fixed by the bitmap functions).
MAX_BITS = 1 << 27
ROW_BITS = 1 << 15
#: Places of a text that are added up together.
RUN = 256


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    group: int = 0  # whose length counts
    least: int = 0  # code points in that group


#: In the order in which spans at one place are listed.
BASE = (
    Rule("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"[Bb]earer\x20[A-Za-z0-9._~+/-]{20,}"),
    Rule("url_login", r"://[A-Za-z0-9._~%-]+:[A-Za-z0-9._~%!-]+@"),
)
RULES = BASE + ADDED


#: A way through a regex: lower-cased characters, None where anything may stand.
Way = tuple[str | None, ...]


class Ways:
    """The ways through a regex, by recursive descent over its alternatives, atoms and quantifiers. Whatever need not be a known
    character counts as anything, so a way never claims a trigram that a match could lack."""

    def __init__(self, regex: str):
        self.text, self.at = regex, 0
        self.all = self.alternatives()
        if self.at < len(regex):
            raise ValueError(f"unbalanced regex: {regex}")

    def peek(self, n: int = 1) -> str:
        return self.text[self.at : self.at + n]

    def next(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self) -> set[Way]:
        out = self.sequence()
        while self.peek() == "|":
            self.next()
            out |= self.sequence()
        return out

    def sequence(self) -> set[Way]:
        ways: set[Way] = {()}
        while self.peek() not in ("", "|", ")"):
            step = self.quantified(self.atom())
            ways = {a + b for a in ways for b in step} if len(ways) * len(step) <= MOST else {(*a, None) for a in ways}
        return ways

    def atom(self) -> set[Way]:
        x = self.next()
        if x == "(":
            if self.peek() == "?":
                if self.peek(2) != "?:":
                    raise ValueError("only (?: of the extensions is known")
                self.at += 2
            inner = self.alternatives()
            if self.next() != ")":
                raise ValueError("unbalanced group")
            return inner
        if x == "[":
            return self.chars()
        if x in "^$":
            return {()}
        return {(None if x == "." else self.escaped() if x == "\\" else self.known(x),)}

    @staticmethod
    def known(x: str) -> str | None:
        return x.lower() if x.isascii() else None

    def escaped(self) -> str | None:
        x = self.next()
        if x == "x":
            self.at += 2
            return self.known(chr(int(self.text[self.at - 2 : self.at], 16)))
        return None if x in string.ascii_letters + string.digits else self.known(x)

    def chars(self) -> set[Way]:
        """A class: each of a few characters, or anything."""
        found: set[str | None] = {None} if self.peek() == "^" else set()
        first = True
        while first or self.peek() != "]":
            x, first = self.next(), False
            found.add(self.escaped() if x == "\\" else self.known(x))
            if self.peek() == "-" and self.peek(2) != "-]":
                found.add(None)
        self.next()
        return {(None,)} if None in found or len(found) > 8 else {(x,) for x in found}

    def quantified(self, one: set[Way]) -> set[Way]:
        q = self.peek()
        if not q or q not in "*+?{":
            return one
        end = self.text.index("}", self.at) + 1 if q == "{" else self.at + 1
        bounds, self.at = self.text[self.at : end], end
        if self.peek() in ("?", "+"):
            self.next()
        if bounds == "?":
            return one | {()}
        lo = {"*": 0, "+": 1}[q] if q != "{" else int(bounds[1:-1].split(",")[0] or 0)
        if bounds == "{1}":
            return one
        return {(*x, None) for x in one} if lo else {(None,)}


#: Letters from the most to the least frequent in English (fixed values). What is no letter counts as rare, the blank as frequent.
FREQUENT = " etaoinshrdlcumwfgypbvkjxqz"


def rarity(gram: str) -> tuple[int, str]:
    return sum(FREQUENT.find(x) if x in FREQUENT else len(FREQUENT) for x in gram), gram


def trigram_query(regex: str, per_way: int = PER_WAY) -> list[frozenset[str]] | None:
    """Any match holds all trigrams of one of the sets at least; None if a match need not hold any. Of a way's trigrams the likely rarest is
    taken, then those that most other ways have, too."""
    ways = []
    for way in Ways(regex).all:
        grams = {"".join(way[i : i + 3]) for i in range(len(way) - 2) if None not in way[i : i + 3]}  # type: ignore[arg-type]
        if not grams:
            return None
        ways.append(frozenset(grams))
    # A way that has all trigrams of another one adds nothing.
    ways = [x for x in set(ways) if not any(y < x for y in ways)]
    out = set()
    for grams in ways:
        first = max(grams, key=rarity)
        more = sorted(grams - {first}, key=lambda g: (-sum(g in w for w in ways), -rarity(g)[0], g))
        out.add(frozenset([first, *more[: per_way - 1]]))
    return sorted(out, key=sorted)


def let(value: Column, f) -> Column:
    """f of a value that is computed once: an expression that stands inside a lambda is computed again for every element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def postings(rows: DataFrame, grams: list[str], blocks: int) -> DataFrame:
    """rows: (key, text). The inverted index: (block, gram, keys)."""
    asked = F.array(*[F.lit(g) for g in grams])
    found = rows.select("key", F.explode(let(F.lower("text"), lambda low: F.filter(asked, lambda g: F.contains(low, g)))).alias("gram"))
    return found.groupBy(F.pmod("key", F.lit(blocks)).alias("block"), "gram").agg(F.collect_set("key").alias("keys"))


def candidates(index: DataFrame, queries: list[list[frozenset[str]] | None]) -> DataFrame:
    """(key, rules): the numbers of the queries that the document passes, of any number of them. Full-scan rules are not asked."""
    by = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("of"))
    none = F.array().cast("array<bigint>")
    get = lambda g: F.coalesce(F.element_at("of", F.lit(g)), none)

    def answer(query: list[frozenset[str]]) -> Column:
        return reduce(F.array_union, [reduce(F.array_intersect, [get(g) for g in sorted(ands)]) for ands in query])

    def tagged(i: int, query: list[frozenset[str]]) -> Column:
        return F.transform(answer(query), lambda k: F.struct(k.alias("key"), F.lit(i).alias("rule")))

    rows = [tagged(i, q) for i, q in enumerate(queries) if q is not None]
    if not rows:
        return index.sparkSession.createDataFrame([], "key long, rules array<int>")
    return by.select(F.explode(F.flatten(F.array(*rows))).alias("x")).groupBy("x.key").agg(F.collect_set("x.rule").alias("rules"))


def may_be(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Adds _may: false only where the row's key is not in keys (key2). A table of bitmaps of MAX_BITS bits at most is broadcast."""
    bits = min(MAX_BITS, max(ROW_BITS, 1 << (16 * keys.count()).bit_length()))
    place = lambda k: F.pmod(k, F.lit(bits))
    bitmaps = keys.groupBy(F.floor(place(F.col("key2")) / ROW_BITS).alias("_row2")).agg(F.bitmap_construct_agg(F.pmod("key2", F.lit(ROW_BITS))).alias("_bitmap"))
    x = rows.withColumn("_row", F.floor(place(F.col("key")) / ROW_BITS)).withColumn("_bit", F.pmod("key", F.lit(ROW_BITS)).cast("int"))
    byte = F.conv(F.hex(F.substring("_bitmap", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    met = x.join(F.broadcast(bitmaps), F.col("_row") == F.col("_row2"), "left")
    return met.withColumn("_may", F.coalesce(F.getbit(byte, F.col("_bit") % 8) == 1, F.lit(False))).drop("_row", "_bit", "_row2", "_bitmap")


ENTRY = "struct<start:int,rank:int,end:int,kind:string>"


def spans(text: Column, rule: Rule, order: int) -> Column:
    """The rule's spans, array of (start, order, end, kind): pieces between matches and matches take turns, so their lengths add up to places.
    They are added up in runs of RUN matches, and the runs then."""
    rx = F.lit(rule.regex)
    sizes = lambda gap, hit, val: F.struct(F.length(gap).alias("gap"), F.coalesce(F.length(hit), F.lit(0)).alias("hit"), F.coalesce(F.length(val) >= rule.least, F.lit(False)).alias("keep"))
    zipped = F.arrays_zip(F.split(text, rule.regex, -1).alias("gap"), F.regexp_extract_all(text, rx, F.lit(0)).alias("hit"), F.regexp_extract_all(text, rx, F.lit(rule.group)).alias("val"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{ENTRY}>").alias("out"))
    entry = lambda begin, end: F.struct(begin.alias("start"), F.lit(order).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["hit"]
        return F.struct(end.alias("at"), F.when(x["keep"], F.concat(acc["out"], F.array(entry(begin, end)))).otherwise(acc["out"]).alias("out"))

    def join(acc: Column, x: Column) -> Column:
        moved = F.transform(x["out"], lambda e: entry(acc["at"] + e["start"], acc["at"] + e["end"]))
        return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], moved).alias("out"))

    def added(parts: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1)), F.lit(RUN)), lambda i: F.aggregate(F.slice(parts, i, RUN), start, step))
        return F.aggregate(runs, start, join, lambda acc: acc["out"])

    return let(F.transform(zipped, lambda x: sizes(x["gap"], x["hit"], x["val"])), added)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, found): all spans of each row by start, then rule."""
    spark = docs.sparkSession
    rows = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    queries = [trigram_query(r.regex) for r in rules]
    grams = sorted({g for q in queries if q for ands in q for g in ands})
    index = stage(postings(rows, grams, shuffle_partitions(spark, docs.count(), BLOCK)), "postings")
    hit = stage(candidates(index, queries).select(F.col("key").alias("key2"), "rules"), "candidates")
    asked = may_be(rows, hit)
    none = F.array().cast(f"array<{ENTRY}>")

    def found(of: DataFrame, full_only: bool) -> DataFrame:
        out = []
        for i, (r, q) in enumerate(zip(rules, queries, strict=True)):
            if q is None:
                out.append(F.when(F.col("text").rlike(r.regex), spans(F.col("text"), r, i)).otherwise(none))
            elif not full_only:
                ask = F.coalesce(F.array_contains("rules", i), F.lit(False))
                out.append(F.when(ask, spans(F.col("text"), r, i)).otherwise(none))
        return of.select("doc_id", F.array_sort(F.concat(*out) if out else none).alias("found"))

    met = asked.where("_may").join(hit, F.col("key") == F.col("key2"), "left")
    return found(asked.where("not _may"), True).unionByName(found(met, False))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans)."""
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text_of = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("found", lambda x: x["rank"] < len(BASE))
    out = scan(docs, doc_id, text)
    return out.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("found")).alias("spans"))
