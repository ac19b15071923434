"""Document search and upkeep: cosine top-k, dedup gates, title twins, chunks, landed pages and sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import keep_one


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays, in double precision; null for zero vectors."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def semantic_search(chunks: DataFrame, query: list[float], k: int, *, where: Column | None = None, vector: str = "vector", report: str = "report_id", page: str = "page", least: float = 0.0, overfetch: int = 4) -> DataFrame:
    """The ``k`` reports with the best chunk: score, best page and how many of the fetched chunks they have.

    Filters go first; ``overfetch * k`` chunks are fetched before grouping (a top-k report).
    """
    pool = chunks if where is None else chunks.where(where)
    scored = pool.withColumn("score", cosine(F.col(vector), F.array(*[F.lit(float(x)) for x in query]))).where(F.col("score") >= least)
    fetched = scored.orderBy(F.desc("score"), report, page).limit(overfetch * k)
    best = fetched.groupBy(report).agg(F.max("score").alias("best_score"), F.max_by(page, F.struct("score", (-F.col(page)).alias("p"))).alias("best_page"), F.count(F.lit(1)).alias("n_chunks"))
    return best.orderBy(F.desc("best_score"), report).limit(k)


def report_with_chunks(reports: DataFrame, chunks: DataFrame, key: str, index: str, text: str) -> DataFrame:
    """Each report with its chunks in order."""
    listed = chunks.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(index, text))).alias("chunks"))
    return reports.join(listed, key, "left")


def vendor_counts(df: DataFrame, vendor: str, date: str, least: int = 1) -> DataFrame:
    """Documents of each vendor with the first and last date."""
    return df.groupBy(vendor).agg(F.count(F.lit(1)).alias("n_docs"), F.min(date).alias("first_date"), F.max(date).alias("last_date")).where(F.col("n_docs") >= least)


def dedup_gates(incoming: DataFrame, stored: DataFrame, gates: dict[str, list[str]]) -> DataFrame:
    """Incoming rows with the first gate (name: key columns) at which a stored row has the same key, or null."""
    out = incoming
    for name, keys in gates.items():
        out = out.join(stored.select(*keys).distinct().withColumn(f"__{name}", F.lit(name)), keys, "left")
    return out.withColumn("dropped_by", F.coalesce(*[F.col(f"__{n}") for n in gates])).drop(*[f"__{n}" for n in gates])


def title_words(title: Column, stop: tuple[str, ...] = ("fwd", "fw", "re", "daily", "weekly", "monthly", "the", "and", "of")) -> Column:
    """A title's distinct words without stop words, numbers and single letters."""
    words = F.array_distinct(F.split(F.lower(F.regexp_replace(title, r"[^\p{L}\p{N}]+", " ")), " "))
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.rlike(r"^\d+$") & ~w.isin(*stop))


#: Words that say nothing about a headline (markers of forwards, cadence words, small words) and serial marks.
TITLE_STOP = ("re", "fw", "fwd", "week", "ahead", "weekly", "daily", "monthly", "monitor", "update", "a", "an", "and", "as", "at", "by", "for", "from", "in", "is", "of", "on", "or", "the", "to", "with")
_FORWARDED = r"^(?i)(?:\s*(?:re|fwd?)\s*:|\s*\[[^\]]*\])+\s*"
_MASTHEAD = r"(?s)^.*?(?:\s*[:|]\s+|\s+[-–—]\s+)(.*)$"
_SERIAL = r"(?:#|\b(?:issue|no|nr|vol|volume|edition|number|part)\b\.?\s*#?)\s*(\d+)"


def title_serial(title: Column) -> Column:
    """The number of an edition ("#1490", "issue 6", "vol. 3") as text, null without one."""
    return F.nullif(F.regexp_extract(F.lower(title), _SERIAL, 1), F.lit(""))


def title_facts(title: Column, vendors: tuple[str, ...] = ()) -> dict[str, Column]:
    """What titles are compared by: ``words`` (without vendors, stop words, numbers and single letters), ``core`` (the words after the
    masthead; null without one), ``spelt`` (lower-case words one space apart, a space around) and ``serial``.
    """
    bare = F.regexp_replace(title, _FORWARDED, "")
    core = F.regexp_extract(bare, _MASTHEAD, 1)
    stop = TITLE_STOP + tuple(v.lower() for v in vendors)
    spelt = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(bare), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    return {"words": title_words(bare, stop), "core": F.when(core != "", title_words(core, stop)), "spelt": spelt, "serial": title_serial(title)}


def title_score(a: dict[str, Column], b: dict[str, Column], *, least_words: int = 3, least_spelt: int = 12) -> Column:
    """How sure it is that ``a`` (incoming) and ``b`` (stored) are one note, from 0 to 1; ``b``'s title may be a part of ``a``'s.

    The best of: the Jaccard similarity of the words; that of the cores if both have a masthead, or of one's core and the other's
    words if one has; 1 if all words of ``b`` are in ``a``, or if ``b``'s title stands word for word in ``a``'s and has ``least_spelt``
    characters. Similarities need ``least_words`` shared words. Titles with different serial numbers score 0.
    """

    def similar(x: Column, y: Column) -> Column:
        both = F.size(F.array_intersect(x, y))
        return F.when(both >= least_words, both / (F.size(x) + F.size(y) - both)).otherwise(0.0)

    inside = F.size(F.array_intersect(a["words"], b["words"]))
    whole = ((inside >= least_words) & (inside == F.size(b["words"]))) | ((F.length(b["spelt"]) - 2 >= least_spelt) & a["spelt"].contains(b["spelt"]))
    cores = F.when(a["core"].isNotNull() & b["core"].isNotNull(), similar(a["core"], b["core"])).when(a["core"].isNotNull(), similar(a["core"], b["words"])).when(b["core"].isNotNull(), similar(a["words"], b["core"])).otherwise(0.0)
    return F.when(a["serial"] != b["serial"], 0.0).when(whole, 1.0).otherwise(F.greatest(similar(a["words"], b["words"]), cores))


def title_matches(incoming: DataFrame, stored: DataFrame, block: list[str], id_col: str, date: str, title: str, *, days: int = 3, least: float = 0.7, vendors: tuple[str, ...] = (), least_words: int = 3, least_spelt: int = 12) -> DataFrame:
    """For each incoming title the stored one of its block (vendor) within ``days`` that is the same note: ``id, twin, score``.

    The best ``title_score`` of at least ``least`` wins, then the nearer date, then the smaller id; a row is never its own twin. Titles
    meet by words: a stored title is filed under its rarest words (of all and of its core), as many as any title that scores
    ``least`` with it must share one of, and an incoming one is looked up by all its words. So the words that most titles
    have bring none together, and days are cut into stretches as in D12. Null titles and dates match nothing; titles of one
    spelling, day and block are compared once, under the smallest id or the two smallest (of which one is not the row itself).
    """
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    names = ["words", "core", "spelt", "serial"]
    facts = lambda df: df.where(F.col(title).isNotNull() & F.col(date).isNotNull()).select(*block, F.col(id_col).alias("id"), F.col(date).cast("date").alias("d"), F.struct(*[c.alias(n) for n, c in title_facts(F.col(title), vendors).items()]).alias("f"))
    some = F.row_number().over(Window.partitionBy(*block, "d", "f").orderBy("id")) <= 2
    files = facts(stored).where(F.size("f.words") > 0).withColumn("__some", some).where("__some").groupBy(*block, "d", "f").agg(F.array_sort(F.collect_set("id")).alias("ids"))  # two at most
    each = files.select(*block, "d", "f", F.explode("f.words").alias("w"))
    counts = each.groupBy(*block, "w").agg(F.count(F.lit(1)).alias("c"))
    sorted_words = each.join(counts, [*block, "w"]).groupBy(*block, "d", "f").agg(F.sort_array(F.collect_list(F.struct("c", "w"))).alias("r"))  # the words of one title

    def head(words: Column) -> Column:
        n = F.size(words)
        return F.slice(words, F.lit(1), F.greatest(n - F.ceil(n * least - 1e-9) + 1, F.lit(1)).cast("int"))

    ranked = F.transform("r", lambda x: x["w"])
    filed = sorted_words.withColumn("ranked", ranked).withColumn("keys", F.array_union(head(F.col("ranked")), F.when(F.col("f.core").isNotNull() & (F.size("f.core") > 0), head(F.filter("ranked", lambda w: F.array_contains("f.core", w)))).otherwise(F.array().cast("array<string>"))))
    width = 2 * days + 1
    filed = filed.select(*block, "d", "f", F.explode("keys").alias("w"), F.floor(day("d") / width).alias("b"))
    asked = facts(incoming).select(*block, F.col("d").alias("da"), F.col("f").alias("a"), F.col("id"))
    looked = asked.select(*block, "da", "a").distinct().withColumn("w", F.explode("a.words")).withColumn("b", F.explode(F.sequence(F.floor((day("da") - days) / width), F.floor((day("da") + days) / width))))
    met = looked.join(filed, [*block, "w", "b"]).where(F.abs(F.datediff("da", "d")) <= days).select(*block, "da", "a", "d", F.col("f").alias("s")).distinct()
    of = lambda side: {n: F.col(f"{side}.{n}") for n in names}
    scored = met.withColumn("score", title_score(of("a"), of("s"), least_words=least_words, least_spelt=least_spelt)).where(F.col("score") >= least)
    found = scored.join(files.select(*block, "d", F.col("f").alias("s"), "ids"), [*block, "d", "s"])
    pairs = asked.join(found, [*block, "da", "a"]).withColumn("twin", F.explode("ids")).where("twin != id")
    best = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), F.abs(F.datediff("da", "d")), "twin"))
    return pairs.withColumn("__n", best).where("__n = 1").select("id", "twin", "score")


def title_twins(df: DataFrame, block: list[str], id_col: str, title: str, least: float = 0.6) -> DataFrame:
    """Pairs of one block (vendor and day) whose title words reach a Jaccard similarity, or contain each other from three words on.

    Titles with different serial numbers are different editions, never twins. Titles of one word set and serial are one node
    under their smallest id: each is linked with that id, and different nodes are
    compared by it, so copies cost a row each and no link between different titles is lost. Words are ordered by how rare
    they are in the block. Sets that reach the similarity share a word among the first n - ceil(least * n) + 1 of either,
    and a contained set has its rarest word in the other: only rows that meet so are compared, so a word that most titles
    have brings titles together only where they hold nothing rarer.
    """
    words = df.select(*block, id_col, F.sort_array(title_words(F.col(title))).alias("w"), F.coalesce(title_serial(F.col(title)), F.lit("")).alias("s")).where(F.size("w") > 0)
    sets = words.groupBy(*block, "w", "s").agg(F.min(id_col).alias("node"))
    copies = words.join(sets, [*block, "w", "s"]).where(F.col(id_col) != F.col("node")).select(*block, F.col("node").alias("a"), F.col(id_col).alias("b"), F.size("w").cast("long").alias("shared"), F.lit(1.0).alias("jaccard"))

    each = sets.select(*block, "node", F.explode("w").alias("__t"))
    counts = each.groupBy(*block, "__t").agg(F.count(F.lit(1)).alias("__c"))
    ranked = each.join(counts, [*block, "__t"]).groupBy(*block, "node").agg(F.sort_array(F.collect_list(F.struct("__c", "__t"))).alias("r"))
    ranked = ranked.select(*block, "node", F.transform("r", lambda x: x["__t"]).alias("r"), F.size("r").alias("n"))
    head = F.slice("r", F.lit(1), (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int"))
    side = lambda name, taken: ranked.select(*block, F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.explode(taken).alias("__t"))
    alike = side("a", head).join(side("b", head), [*block, "__t"]).where("a < b").select(*block, "a", "b")
    inside = side("a", F.slice("r", 1, 1)).where("na >= 3").join(side("b", F.col("r")), [*block, "__t"]).where("a != b and na <= nb")
    met = alike.union(inside.select(*block, F.least("a", "b"), F.greatest("a", "b"))).distinct()

    known = sets.select(*block, "node", "w", "s")
    met = met.join(known.toDF(*block, "a", "wa", "sa"), [*block, "a"]).join(known.toDF(*block, "b", "wb", "sb"), [*block, "b"])
    met = met.where("sa = sb or sa = '' or sb = ''").withColumn("shared", F.size(F.array_intersect("wa", "wb")).cast("long"))
    met = met.withColumn("jaccard", F.col("shared") / (F.size("wa") + F.size("wb") - F.col("shared")))
    contained = (F.col("shared") >= 3) & (F.col("shared") == F.least(F.size("wa"), F.size("wb")))
    return met.where((F.col("jaccard") >= least) | contained).select(*block, "a", "b", "shared", "jaccard").unionByName(copies)


def chunk(df: DataFrame, id_col: str, text: str, size: int = 1000, overlap: int = 100) -> DataFrame:
    """Texts cut into stretches of ``size`` characters that overlap; short and empty texts are one chunk."""
    step = size - overlap
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - overlap - 1, F.lit(0)), F.lit(step))
    return df.where(F.col(text).isNotNull()).select(id_col, text, F.posexplode(starts).alias("chunk_index", "start")).select(id_col, "chunk_index", "start", F.substring(F.col(text), F.col("start") + 1, F.lit(size)).alias("chunk_text"))


def missing_chunks(reports: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """Reports without a chunk."""
    return reports.join(chunks.select(key).distinct(), key, "left_anti")


def fill_country(df: DataFrame, tags: DataFrame, key: str, country: str) -> DataFrame:
    """A blank country filled where exactly one country tag is there; others are left and marked."""
    one = tags.groupBy(key).agg(F.countDistinct("country_tag").alias("__n"), F.min("country_tag").alias("__c"))
    blank = F.col(country).isNull() | (F.col(country) == "")
    out = df.join(one, key, "left")
    return out.withColumn("fill_status", F.when(~blank, "kept").when(F.col("__n") == 1, "filled").when(F.col("__n") > 1, "several").otherwise("none")).withColumn(country, F.when(blank & (F.col("__n") == 1), F.col("__c")).otherwise(F.col(country))).drop("__n", "__c")


def html_items(df: DataFrame, id_col: str, html: str, pattern: str, groups: list[str]) -> DataFrame:
    """A row for each match of a pattern in a landed page, its groups as columns."""
    found = F.arrays_zip(*[F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(k + 1)).alias(g) for k, g in enumerate(groups)])
    return df.select(id_col, F.posexplode(found).alias("item", "__m")).select(id_col, "item", *[F.col("__m")[g].alias(g) for g in groups])


def matrix_to_long(cells: DataFrame, sheet: str, year_row: int, month_row: int, data_row: int, label_col: int) -> DataFrame:
    """Cells (sheet, row, col, text) of a year row over a month row as (sheet, label, year, month, value).

    Years are carried to the right and rise where the month numbers fall.
    """
    head = cells.where(F.col("row") == month_row).select(sheet, "col", F.col("text").try_cast("int").alias("month")).where("month is not null")
    years = cells.where(F.col("row") == year_row).select(sheet, "col", F.col("text").try_cast("int").alias("anchor"))
    w = Window.partitionBy(sheet).orderBy("col")
    head = head.join(years, [sheet, "col"], "left")
    head = head.withColumn("__fall", ((F.lag("month").over(w) >= F.col("month")) & F.col("anchor").isNull()).cast("int"))
    head = head.withColumn("__block", F.count("anchor").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(sheet, "__block").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    head = head.withColumn("year", F.first("anchor", ignorenulls=True).over(inside) + F.coalesce(F.sum("__fall").over(inside), F.lit(0)))
    labels = cells.where((F.col("col") == label_col) & (F.col("row") >= data_row)).select(sheet, "row", F.trim("text").alias("label")).where("label != ''")
    body = cells.where((F.col("row") >= data_row) & (F.col("col") != label_col)).select(sheet, "row", "col", F.regexp_replace("text", ",", "").try_cast("double").alias("value"))
    return body.where("value is not null").join(head, [sheet, "col"]).join(labels, [sheet, "row"]).select(sheet, "label", "year", "month", "value")


def newest_per(df: DataFrame, keys: list[str], date: str, id_col: str) -> DataFrame:
    """The newest document of each key, ties to the smaller id."""
    return keep_one(df, keys, F.desc(date), F.col(id_col))


def hits_with_report(hits: DataFrame, reports: DataFrame, vendors: DataFrame, report: str, vendor: str) -> DataFrame:
    """Search hits with their report's and its vendor's columns; a hit whose report or vendor is gone stays, with nulls."""
    return hits.join(reports, report, "left").join(vendors, vendor, "left")
