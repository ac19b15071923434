"""Secret scanning through a trigram inverted index, with DataFrame functions only.

Each rule's regular expression is turned into a Boolean query over trigrams that any match must contain. The corpus is
indexed for the trigrams that some query asks for: postings (trigram, document). The posting lists of a clause are
intersected, and only the documents found are read again and verified with the expression itself. A rule without
mandatory trigrams is verified on every text.
"""

from __future__ import annotations

import re
import re._constants as kinds
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.durable import durable

BROADCAST_ROWS = 200_000
MOST_STRINGS = 64
_OPEN, _SHUT, _OTHER = "\x01", "\x02", "\x03"


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost non-overlapping matches; those count whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int


#: The base rules, in the order in which spans that start together are listed.
RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
_WORD = r"[^\x20\x09-\x0D:/@]"
#: Further rules, listed after the base ones: key blocks, signed web tokens, vendors' key prefixes, connection strings.
MORE_RULES = (
    Rule("key_block", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----[^-]+-----END\x20[A-Z\x20]*PRIVATE\x20KEY-----", 0, 64),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("hosting", r"(?:ghp|github_pat)_[A-Za-z0-9_]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("search", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("payment", r"(?:sk|rk)_live_[A-Za-z0-9]+", 0, 24),
    Rule("connection", rf"(?:postgres|postgresql|mysql|mongodb|redis|amqp)://{_WORD}+:{_WORD}+@{_WORD}+", 0, 16),
)
ALL_RULES = RULES + MORE_RULES


def trigram_clauses(pattern: str) -> list[frozenset[str]] | None:
    """The query of an expression: a text with a match contains all trigrams of at least one clause (lower-cased).

    None means that some match has no mandatory trigram, so that every text must be verified.
    """
    clauses = [frozenset(s[i : i + 3] for s in runs for i in range(len(s) - 2)) for runs in _runs(parser.parse(pattern))]
    clauses = [c for c in clauses if not any(d < c for d in clauses)]
    return None if not clauses or frozenset() in clauses else sorted(set(clauses), key=sorted)


def _runs(tree) -> list[list[str]]:
    """Ways to match ``tree``, each as the literal runs that it must contain in order; a gap separates runs."""
    ways: list[list[str]] = [[""]]
    for op, arg in tree:
        if op is kinds.LITERAL:
            parts = [[chr(arg).lower()]]
        elif op is kinds.SUBPATTERN:
            parts = _runs(arg[3])
        elif op is kinds.BRANCH:
            parts = [way for branch in arg[1] for way in _runs(branch)]
        elif op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and arg[0] >= 1:
            parts = [[*way, ""] if arg[1] != 1 else way for way in _runs(arg[2])]
        elif op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and arg[1] == 1:
            parts = [[""], *_runs(arg[2])]
        else:
            parts = [["", ""]]  # anything else only breaks the run
        if len(ways) * len(parts) > MOST_STRINGS:
            parts = [["", ""]]
        ways = [[*way[:-1], way[-1] + part[0], *part[1:]] for way, part in product(ways, parts)]
    return ways


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """``gram, id`` for rows of ``id, text``: the inverted index, for the given trigrams, of the lower-cased texts."""
    low = F.lower("text")
    there = F.filter(F.array(*[F.when(F.contains(low, F.lit(g)), F.lit(g)) for g in trigrams]), lambda g: g.isNotNull())
    return docs.select("id", F.explode(there).alias("gram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Distinct ids of the documents in which some indexed rule's query holds."""
    spark = docs.sparkSession
    queries = {r.kind: trigram_clauses(r.pattern) for r in rules}
    clauses = [c for q in queries.values() if q for c in q]
    if not clauses:
        return docs.select("id").limit(0)
    terms = spark.createDataFrame([(n, g, len(c)) for n, c in enumerate(clauses) for g in sorted(c)], "clause int, gram string, size int")
    index = postings(docs, sorted({g for c in clauses for g in c}))
    met = index.distinct().join(F.broadcast(terms), "gram").groupBy("id", "clause", "size").agg(F.count(F.lit(1)).alias("n"))
    return met.where("n = size").select("id").distinct()


def matches(text: Column, rule: Rule) -> Column:
    """Array of ``kind, start, end`` (code points, end exclusive) of the rule's matches in a text.

    Matches are wrapped in two control characters and the text is split there, so every second piece is a match. The
    same characters of the text itself become a third one first, which no rule can match.
    """
    quiet = F.translate(text, _OPEN + _SHUT, _OTHER * 2)
    pieces = F.split(F.regexp_replace(quiet, F.lit(f"({rule.pattern})"), F.lit(f"{_OPEN}$1{_SHUT}")), f"[{_OPEN}{_SHUT}]")
    zero = F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit"), F.array().cast("array<struct<kind:string,start:int,end:int>>").alias("found"))
    long_enough = (lambda piece: F.length(piece) >= rule.least) if rule.group == 0 else (lambda piece: F.length(F.regexp_extract(piece, rule.pattern, rule.group)) >= rule.least)

    def step(state: Column, piece: Column) -> Column:
        span = F.struct(F.lit(rule.kind).alias("kind"), state["at"].alias("start"), (state["at"] + F.length(piece)).alias("end"))
        found = F.when(state["hit"] & long_enough(piece), F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct((state["at"] + F.length(piece)).alias("at"), (~state["hit"]).alias("hit"), found.alias("found"))

    return F.when(F.size(pieces) > 1, F.aggregate(pieces, zero, step, lambda state: state["found"])).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int>>"))


def _longer(rule: Rule) -> Rule:
    """The rule as the full scan runs it: where the whole match is one run of a class, short runs need not match at all."""
    tail = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return Rule(rule.kind, f"{tail[1]}{{{rule.least},}}", 0, rule.least) if tail and rule.group == 0 else rule


def _spans(text: Column, verify: Column, rules: tuple[Rule, ...]) -> Column:
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    each = [matches(text, _longer(r)) if trigram_clauses(r.pattern) is None else F.when(verify, matches(text, r)).otherwise(none) for r in rules]
    rank = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k)])
    keyed = F.transform(F.concat(*each), lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``id, text, spans`` of every row; spans are ``kind, start, end``, by start, then in the order of ``rules``.

    Null and empty texts have no spans (and come back as the empty text). Repeated rows give repeated rows; rows that
    share an id are verified each. Rows with a null id are verified without the index. Other columns are not carried:
    ``df`` may nest them in a struct column named ``rest``, which comes along.
    """
    rest = ["rest"] if dict(df.dtypes).get("rest", "").startswith("struct") else []
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *rest)
    found = durable(candidates(docs.where("id is not null"), rules)).withColumn("candidate", F.lit(True))
    # candidates grow with the corpus: they are broadcast only when counted and few, else joined by a shuffle
    small = found.count() <= BROADCAST_ROWS
    marked = docs.join(F.broadcast(found) if small else found, "id", "left")
    verify = F.coalesce("candidate", F.col("id").isNull())
    return marked.select("id", "text", *rest, _spans(F.col("text"), verify, rules).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of scanned rows: counts and hash of the base rules' spans, and all spans."""
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in RULES]))
    kinds_found = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds_found, r.kind))).cast("long").alias(f"n_{r.kind}") for r in RULES]
    return scanned.select(F.col("id").alias("doc_id"), *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redacted(mark: str = "[secret]") -> Column:
    """The ``text`` of a scanned row with every stretch that some span covers replaced by ``mark``."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, span: Column) -> Column:
        between = F.col("text").substr(state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        fresh = F.when(span["start"] >= state["at"], F.array(between, F.lit(mark))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["parts"], fresh).alias("parts"))

    rest = lambda state: F.concat(F.array_join(state["parts"], ""), F.col("text").substr(state["at"] + 1, F.length("text")))
    return F.when(F.size("spans") == 0, F.col("text")).otherwise(F.aggregate("spans", zero, step, rest))


def redact_column(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", **options) -> DataFrame:
    """``df`` with its secrets replaced in the text column, all columns and rows kept.

    Null texts stay null; ``length_col`` is set to the new length where a text has changed.
    """
    nested = df.select(F.col(id_col), F.col(text_col), F.struct(*df.columns).alias("rest"))
    done = scan(nested, id_col, text_col, **options).withColumn("clean", redacted())
    hit = F.size("spans") > 0
    value = {text_col: F.when(hit, F.col("clean")).otherwise(F.col(f"rest.`{text_col}`"))}
    if length_col in df.columns:
        value[length_col] = F.when(hit, F.length("clean").cast(dict(df.dtypes)[length_col])).otherwise(F.col(f"rest.`{length_col}`"))
    return done.select(*[value.get(c, F.col(f"rest.`{c}`")).alias(c) for c in df.columns])


ORACLE_SQL = """
WITH quiet AS (
    SELECT doc_id, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS t FROM documents
), pieces AS (
    SELECT doc_id, 'assign' AS kind, 0 AS rank, string_split_regex(regexp_replace(t, '((?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?[A-Za-z0-9+/_.=-]+)', chr(1) || '\\1' || chr(2), 'g'), '[\\x01\\x02]') AS p FROM quiet
    UNION ALL
    SELECT doc_id, 'access', 1, string_split_regex(regexp_replace(t, '(AKIA[A-Z0-9]+)', chr(1) || '\\1' || chr(2), 'g'), '[\\x01\\x02]') FROM quiet
    UNION ALL
    SELECT doc_id, 'hex', 2, string_split_regex(regexp_replace(t, '([0-9a-f]+)', chr(1) || '\\1' || chr(2), 'g'), '[\\x01\\x02]') FROM quiet
), numbered AS (
    SELECT doc_id, kind, rank, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM pieces
), placed AS (
    SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id, kind ORDER BY k) AS fin FROM numbered
), spans AS (
    SELECT doc_id, kind, rank, fin - length(piece) AS start, fin FROM placed
    WHERE k % 2 = 0 AND CASE kind
        WHEN 'assign' THEN length(regexp_extract(piece, '(?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1)) >= 12
        WHEN 'access' THEN length(piece) >= 18 ELSE length(piece) >= 16 END
), listed AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || start::BIGINT || ':' || fin::BIGINT, ',' ORDER BY start, rank) AS spans
    FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN listed USING (doc_id)
"""
