"""Secret scans by a trigram inverted index, in DataFrame functions only.

Each rule's regular expression is turned into a Boolean query over trigrams that any match must hold: an OR of ANDs, found by
walking the parsed expression. Postings (trigram, text) are kept for the trigrams of the queries; the query of a rule is
answered by intersecting postings, and only its candidates are verified with the expression itself. A rule without mandatory trigrams scans
every text. Trigrams are of the lower-cased text, so case never loses a candidate.

Postings are keyed by a hash of id and text: a collision can only add a candidate. Candidates are verified where
their text is, after one shuffled left join, which splits where one key is hot.

Defined cases: a null text is empty and has no spans; texts are scanned whole, however long; repeated rows get the same
spans each; an empty table gives no rows. Other columns pass through; an input column named like the output is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<start:int,rank:int,end:int,kind:string>"
_SPANS = f"array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern` whose `group` has `least` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The first three are the base rules. Quantifiers of the second and third include their least length; that finds the same
#: spans, since each match takes a whole run of its class. A jwt begins where a run of its characters does, so a long run is scanned once.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("model", r"sk-[A-Za-z0-9_-]{20,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
)
BASE = 3
_MOST = 64  # exact strings that are tracked at once
_KEPT = 6  # trigrams that an alternative keeps


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of trigrams (in lower case) of which one must be in any text that matches, whole; None if there is no such."""
    from re import _constants as c
    from re import _parser as parser

    def cross(a: set[str], b: set[str]) -> set[str] | None:
        return {x + y for x in a for y in b} if len(a) * len(b) <= _MOST else None

    def need(words: set[str]) -> list[frozenset[str]] | None:
        found = [frozenset(w[i : i + 3] for i in range(len(w) - 2)) for w in words]
        return found if found and all(found) else None

    def both(a, b):
        if a is None or b is None:
            return a or b
        return [x | y for x in a for y in b] if len(a) * len(b) <= _MOST else min(a, b, key=len)

    def exact(op, arg) -> set[str] | None:
        """All strings that this item matches, if they are few."""
        if op is c.LITERAL:
            return {chr(arg).lower()}
        if op is c.IN and all(o is c.LITERAL for o, _ in arg) and len(arg) <= 8:
            return {chr(x).lower() for _, x in arg}
        if op is c.SUBPATTERN:
            return exact_all(arg[-1])
        if op is c.BRANCH:
            parts = [exact_all(x) for x in arg[1]]
            return set().union(*parts) if all(p is not None for p in parts) else None
        if op in (c.MAX_REPEAT, c.MIN_REPEAT) and arg[1] <= 4:
            one, out = exact_all(arg[2]), None
            if one is not None:
                out, now = set(), {""}
                for n in range(arg[1] + 1):
                    out |= now if n >= arg[0] else set()
                    now = cross(now, one)
                    if now is None:
                        return None
            return out
        return None

    def exact_all(items) -> set[str] | None:
        out: set[str] | None = {""}
        for op, arg in items:
            e = exact(op, arg)
            out = cross(out, e) if e is not None else None
            if out is None:
                return None
        return out

    def walk(items):
        query, run = None, {""}
        for op, arg in items:
            e = exact(op, arg)
            longer = cross(run, e) if e is not None else None
            if longer is not None:
                run = longer
                continue
            query, run = both(query, need(run)), {""}
            if op is c.SUBPATTERN:
                query = both(query, walk(arg[-1]))
            elif op is c.BRANCH:
                parts = [walk(x) for x in arg[1]]
                query = both(query, [a for p in parts for a in p] if all(parts) else None)
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT) and arg[0] >= 1:
                query = both(query, walk(arg[2]))
        return both(query, need(run))

    query = walk(parser.parse(pattern))
    if query is None:
        return None
    least = {a for a in query if not any(b < a for b in query)}  # an alternative that holds another is superfluous
    return sorted((frozenset(sorted(a)[:_KEPT]) for a in least), key=sorted)  # any part of an AND is mandatory as well


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's spans in a text, by offset in code points: lengths of what the expression leaves and of what it takes, summed up."""
    pattern = F.lit(rule.pattern)
    taken = F.regexp_extract_all(text, pattern, F.lit(0))
    held = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else taken
    between = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(taken))
    state = f"struct<at:int,out:{_SPANS}>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out")).cast(state)

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(x["0"])
        end = begin + F.length(x["1"])
        span = F.array(F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))).cast(_SPANS)
        return F.struct(end.alias("at"), F.when(F.length(x["2"]) >= rule.least, F.concat(a["out"], span)).otherwise(a["out"]).alias("out")).cast(state)

    zipped = F.arrays_zip(between.alias("0"), taken.alias("1"), held.alias("2"))
    return F.aggregate(zipped, start, step, lambda a: a["out"])


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index of the trigrams in use: a row (gram, key) for each text that holds trigram number `gram`."""
    low = F.col("__low")
    held = F.filter(F.array(*[F.when(F.contains(low, F.lit(g)), F.lit(i)) for i, g in enumerate(trigrams)]), lambda x: x.isNotNull())
    return docs.select("__key", F.lower("__text").alias("__low")).select("__key", F.explode(held).alias("gram"))


def find(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds secret_spans, an array of (start, rank, end, kind), by start and then by the order of the rules."""
    docs = docs.drop("secret_spans")
    asked = {r.kind: trigram_query(r.pattern) for r in rules}
    trigrams = sorted({g for q in asked.values() for a in q or [] for g in a})
    rows = docs.withColumn("__text", F.coalesce(F.col(text).cast("string"), F.lit(""))).withColumn("__key", F.xxhash64(id_col, "__text"))
    number = {g: i for i, g in enumerate(trigrams)}
    if len(trigrams) > 62:
        raise ValueError(f"the rules need {len(trigrams)} trigrams; an index holds 62")
    word = lambda grams: sum(1 << number[g] for g in grams)
    spans = [matches(F.col("__text"), r, i) if asked[r.kind] is None else None for i, r in enumerate(rules)]
    indexed = [(i, r) for i, r in enumerate(rules) if asked[r.kind] is not None]
    if indexed:
        held = postings(rows, trigrams).groupBy("__key").agg(F.bit_or(F.expr("shiftleft(1L, gram)")).alias("held"))
        hit = lambda q: reduce(lambda a, b: a | b, [F.col("held").bitwiseAND(F.lit(word(a))) == F.lit(word(a)) for a in q])
        which = reduce(lambda a, b: a.bitwiseOR(b), [F.when(hit(asked[r.kind]), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in indexed])
        candidates = held.select("__key", which.alias("__which")).where("__which > 0")
        rows = rows.join(candidates.hint("shuffle_hash"), "__key", "left")  # texts are neither sorted nor held
        for i, r in indexed:
            spans[i] = F.when(F.col("__which").bitwiseAND(F.lit(1 << i)) > 0, matches(F.col("__text"), r, i))
    none = F.array().cast(_SPANS)
    guarded = [F.coalesce(F.when(F.col("__text").rlike(r.pattern), s), none) if asked[r.kind] is None else F.coalesce(s, none) for s, r in zip(spans, rules, strict=True)]
    found = F.array_sort(F.concat(*guarded))
    return rows.withColumn("secret_spans", found).select(*docs.columns, "secret_spans")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(found: DataFrame, *, text: str = "text") -> DataFrame:
    """Replaces what the spans cover by [secret]; overlapping spans become one. secret_spans goes, the other columns stay."""
    state = "struct<at:int,out:string>"
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast(state)

    def step(a: Column, x: Column) -> Column:
        gap = F.concat(a["out"], F.substring(t, a["at"] + 1, x["start"] - a["at"]), F.lit("[secret]"))
        out = F.when(x["start"] >= a["at"], gap).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), out.alias("out")).cast(state)

    clean = F.aggregate("secret_spans", start, step, lambda a: F.concat(a["out"], F.substring(t, a["at"] + 1, F.length(t))))
    return found.withColumn(text, F.when(F.size("secret_spans") > 0, clean).otherwise(F.col(text))).drop("secret_spans")


def brute_force(text: str | None, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int, str]]:
    """The spans of one text by scanning it with every rule: what `find` is tested against."""
    out = []
    for i, r in enumerate(rules):
        out += [(m.start(), i, m.end(), r.kind) for m in re.finditer(r.pattern, text or "", re.ASCII) if len(m.group(r.group)) >= r.least]
    return sorted(out)
