"""Secret scan by a trigram inverted index.

Each rule's regular expression yields a Boolean trigram query. One pass over the
texts makes postings (trigram, document) for the trigrams that queries mention;
grouping the postings by document and rule intersects them, and only the candidate
documents' texts are joined back and verified. Rules without mandatory trigrams are
run on every text in the first pass. All of it is DataFrame functions.

Spans are code points, end exclusive, leftmost and non-overlapping for each kind.

Edge cases: a null text counts as empty; texts without secrets have no spans; equal
rows are each scanned and kept; documents are keyed by id (by text where the id is
null), so an id that several rows share only adds candidates. Columns to be kept travel
in one, so their names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running
from .trigrams import clauses


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java, RE2 and Python share; group ``group`` must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either(w) for w in ("password", "passwd", "secret", "token")) + f"|{_either('api')}_?{_either('key')}"
#: The kinds that the contract fixes, in its order.
BASE = [
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
]
#: Further kinds, by the published shapes of these credentials.
MORE = [
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
RULES = BASE + MORE
SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"
#: Code points of a piece of a text that is redacted.
PIECE = 4096


def find(text: Column, rule: Rule) -> Column:
    """All spans of ``rule`` in ``text``: the gaps between matches and the matches give the offsets."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda g: F.length(g).cast("bigint"))
    sized = F.transform(matches, lambda m: F.struct(F.length(m).cast("bigint").alias("n"), (F.length(F.regexp_extract(m, rule.pattern, rule.group)) if rule.group else F.length(m)).alias("g")))
    pieces = F.zip_with(F.slice(gaps, 1, F.size(sized)), sized, lambda gap, m: gap + m["n"])
    before = running(pieces, lambda a, x: a + x)
    ends = F.zip_with(before, pieces, lambda a, x: a + x)
    every = F.zip_with(ends, sized, lambda end, m: F.struct(F.lit(rule.kind).alias("kind"), (end - m["n"]).alias("start"), end.alias("end"), (m["g"] >= rule.least).alias("ok")))
    spans = F.transform(F.filter(every, lambda s: s["ok"]), lambda s: F.struct(s["kind"], s["start"], s["end"])).cast(SPAN)
    return F.when(text.rlike(rule.pattern), spans).otherwise(F.array().cast(SPAN))


def _key(doc_id: str, text: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).cast("string")))


def postings(docs: DataFrame, rules: list[Rule], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index: rows (trigram, key) for each trigram of the rules' queries that a text contains."""
    wanted = sorted({t for r in rules for clause in clauses(r.pattern) for t in clause})
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    read = docs.select(_key(doc_id, text).alias("key"), low.alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted]))
    return read.select("key", F.explode(present).alias("trigram"))


def candidates(docs: DataFrame, rules: list[Rule], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, kinds): the rules of which a document satisfies every clause."""
    spark = docs.sparkSession
    terms = [(t, r.kind, f"{r.kind}:{i}", len(q)) for r in rules for q in [clauses(r.pattern)] for i, clause in enumerate(q) for t in clause]
    rows = [F.struct(F.lit(t).alias("trigram"), F.lit(k).alias("kind"), F.lit(c).alias("clause"), F.lit(n).alias("of")) for t, k, c, n in terms]
    query = spark.range(1).select(F.explode(F.array(*rows)).alias("q")).select("q.*")
    met = postings(docs, rules, doc_id, text).join(F.broadcast(query), "trigram")  # a few rows for each rule
    whole = met.groupBy("key", "kind").agg(F.countDistinct("clause").alias("n"), F.first("of").alias("of")).filter("n = of")
    return whole.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def in_order(spans: Column, rules: list[Rule]) -> Column:
    """By start, then by the order of ``rules``."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def scan(docs: DataFrame, rules: list[Rule] | None = None, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, *carry, spans): for each document all its spans in order. ``carry`` names columns to keep; one named spans is replaced."""
    kept = [c for c in carry if c not in (doc_id, "spans")]
    found = scanned(docs.select(F.struct(doc_id, *kept).alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), rules)
    return found.select(F.col("row").getField(doc_id).alias(doc_id), *[F.col("row").getField(c).alias(c) for c in kept], "spans")


def scanned(rows: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Rows (row, text, spans) from rows (row, doc_id, text): the document travels in ``row``, so no name can clash."""
    rules = rules or RULES
    queried = [r for r in rules if clauses(r.pattern)]
    whole = [r for r in rules if not clauses(r.pattern)]
    base = rows.select(_key("doc_id", "text").alias("key"), "row", F.coalesce("text", F.lit("")).alias("text"))
    if queried:
        base = base.join(candidates(rows, queried), "key", "left")
    spans = [find(F.col("text"), r) for r in whole]
    spans += [F.when(F.array_contains("kinds", r.kind), find(F.col("text"), r)).otherwise(F.array().cast(SPAN)) for r in queried]
    return base.select("row", "text", in_order(F.concat(*spans), rules).alias("spans"))


def redact(docs: DataFrame, rules: list[Rule] | None = None, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = None) -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets; ``n_chars`` names a column of lengths to keep right."""
    found = scanned(docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), rules)
    clean = found.select("row", (F.size("spans") > 0).alias("changed"), redacted(F.col("text"), F.col("spans")).alias("clean"))

    def column(c: str) -> Column:
        old = F.col("row").getField(c)
        if c == text:
            return F.when(F.col("changed"), F.col("clean")).otherwise(old).alias(c)
        if c == n_chars:
            return F.when(F.col("changed"), F.length("clean").cast(docs.schema[c].dataType)).otherwise(old).alias(c)
        return old.alias(c)

    return clean.select(*[column(c) for c in docs.columns])


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every stretch that spans cover replaced by ``[kind]`` of the stretch's first span."""
    # The text in pieces, so that a part is found without passing over all before it.
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def part(begin: Column, end: Column) -> Column:
        at = F.sequence(F.floor(begin / PIECE), F.floor((end - 1) / PIECE))
        cut = lambda k: F.substring(F.get(pieces, k.cast("int")), (F.greatest(begin - k * PIECE, F.lit(0)) + 1).cast("int"), F.least(end - k * PIECE, F.lit(PIECE)) - F.greatest(begin - k * PIECE, F.lit(0)).cast("int"))
        return F.when(end > begin, F.array_join(F.transform(at, cut), "")).otherwise(F.lit(""))

    reached = running(F.transform(spans, lambda s: s["end"]), F.greatest)  # a stretch begins where no earlier span reaches
    shown = F.zip_with(spans, reached, lambda s, at: F.when(s["start"] >= at, F.concat(part(at, s["start"]), F.lit("["), s["kind"], F.lit("]"))).otherwise(F.lit("")))
    rest = part(F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text).cast("bigint"))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(shown, ""), rest)).otherwise(text)
