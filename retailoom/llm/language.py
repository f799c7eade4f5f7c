"""Language identification by fusing evidence.

posterior(l) ~ P(text | l) * P(declared | l) * P(address suffix | l) * prior(l | host)

Text likelihoods come from byte trigrams, counted as rows (language, trigram) over all texts that declare a language.
Each text votes for its likeliest language; grouped counts of these votes give what the declarations and the address
suffixes say about a language, and the priors of hosts, smoothed towards their domain and that towards all.

The posterior only tells the declared languages apart. Whether a text is in any of them is told by its fit: the mean log
likelihood of its trigrams in its likeliest language, without its own share in the counts. A text is out of language if
its fit is below a floor between the median fit of the language and what random bytes get from the language's table.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailoom.llm.main_text import host_of, main_text
from retailoom.llm.store import Scratch, in_blocks
from retailoom.llm.text import LOWER, text_slices

CODE = r"^\s*([a-z]{2,3})(?:[-_\s]|$)"  # a language code has two or three letters (ISO 639), so there are at most 18,252
MOST_SENT = 1 << 20  # counts that are sent to every task; more are joined to blocks of texts
BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20
HOT_SHARE = 4096
TEXT_WEIGHT = 200  # a text counts as this many trigrams at most: they are not independent
SMOOTHING = 10.0
LEAST_FIT = 0.5  # how far a fit may fall from the median towards that of random bytes; short texts by 1 / sqrt(trigrams) more
SALTS = 16


def _codes(data: np.ndarray) -> np.ndarray:
    """Trigram that starts at each byte but the last two, A-Z lower-cased and white space as one kind."""
    low = LOWER[data].astype(np.int32)
    low[(low < 33)] = 32
    return low[:-2] << 16 | low[1:-1] << 8 | low[2:]


def _row_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a slice and the row of each; trigrams across rows are left out."""
    if len(data) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    codes = _codes(data)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = row[:-2] == row[2:]
    return codes[whole], row[:-2][whole]


def gram_counts(texts: DataFrame, languages: list[str]) -> DataFrame:
    """(gram, language, n): trigram counts over all texts (columns text, declared) that declare one of the languages, by its number."""
    number = {name: i for i, name in enumerate(languages)}

    def count(batches):
        for batch in batches:
            labels = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for first, _, data, offsets in text_slices(batch.column(0)):
                codes, row = _row_codes(data, offsets)
                seen, n = np.unique(labels[first + row] << 24 | codes, return_counts=True)
                yield pa.record_batch([pa.array((seen & 0xFFFFFF).astype(np.int32)), pa.array((seen >> 24).astype(np.int32)), pa.array(n)], ["gram", "language", "n"])

    known = texts.where("declared is not null").select("text", "declared")
    return known.mapInArrow(count, "gram int, language int, n long").groupBy("gram", "language").agg(F.sum("n").alias("n"))


class Counts:
    """Trigram counts as a task holds them: of all trigrams, or of those that occur in a block of texts."""

    def __init__(self, gram: np.ndarray, language: np.ndarray, n: np.ndarray, many: int):
        self.grams = np.unique(gram)
        order = np.argsort(language, kind="stable")
        self.place = np.searchsorted(self.grams, gram)[order]
        self.n = n[order]
        self.begins = np.searchsorted(language[order], np.arange(many + 1))

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Where the counts of trigrams stand; unseen ones stand behind all others, at a count of 0."""
        if not len(self.grams):
            return np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        return np.where(self.grams[at] == codes, at, len(self.grams))

    def of(self, i: int) -> np.ndarray:
        out = np.zeros(len(self.grams) + 1)
        mine = slice(self.begins[i], self.begins[i + 1])
        out[self.place[mine]] = self.n[mine]
        return out


def _scores(texts: pa.Array, said: np.ndarray, counts: Counts, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: trigrams, log likelihood in each language, fit.

    The fit is the mean in the likeliest language; a text that declares it (``said``) is taken out of its counts.
    """
    many = len(sizes)
    count, total, fits = np.zeros(len(said), np.int64), np.zeros((len(said), many)), np.zeros(len(said))
    for first, last, data, offsets in text_slices(texts):
        codes, row = _row_codes(data, offsets)
        at = counts.places(codes)
        rows = last - first
        count[first:last] = size = np.bincount(row, minlength=rows)
        for i in range(many):
            total[first:last, i] = np.bincount(row, weights=np.log((counts.of(i) + 0.5) / sizes[i])[at], minlength=rows)
        best = total[first:last].argmax(axis=1)
        fits[first:last] = total[np.arange(first, last), best] / np.maximum(size, 1)
        for i in np.unique(best[said[first:last] == best]):
            mine = np.flatnonzero((said[first:last] == i) & (best == i))
            chosen = np.isin(row, mine)
            # a declaring row's own trigrams are all among the counts
            pairs, own = np.unique(row[chosen] * np.int64(len(counts.grams) + 1) + at[chosen], return_counts=True)
            of, gram = np.divmod(pairs, len(counts.grams) + 1)
            rest = np.maximum(counts.of(i)[gram] + 0.5 - own, 0.5) / (sizes[i] - size[of])
            without = np.bincount(of, weights=own * np.log(rest), minlength=rows) / np.maximum(size, 1)
            fits[first:last][mine] = without[mine]
    return count, total, fits


def _likelihoods(rows: DataFrame, model: DataFrame, languages: list[str], sizes: np.ndarray, scratch: Scratch, sent: int = MOST_SENT) -> DataFrame:
    """Adds ``grams`` (trigrams), ``likelihoods`` (log, one per language, tempered) and ``fit`` to (id, key, declared, host, suffix, text).

    Up to ``sent`` counts go to every task as they are. Beyond, texts are dealt to blocks, and each block gets the counts of its trigrams.
    """
    number = {name: i for i, name in enumerate(languages)}
    names = ["id", "key", "declared", "host", "suffix"]

    def judged(batch, counts: Counts) -> list[pa.Array]:
        said = np.array([number.get(x, -1) for x in batch.column("declared").to_pylist()], np.int64)
        count, total, fits = _scores(batch.column("text"), said, counts, sizes)
        total *= (np.minimum(count, TEXT_WEIGHT) / np.maximum(count, 1))[:, None]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, len(sizes), dtype=np.int32)), pa.array(total.ravel()))
        return [*[batch.column(n) for n in names], pa.array(count), lists, pa.array(fits)]

    def arrays(table) -> list[np.ndarray]:
        return [table.column(n).to_numpy() for n in ("gram", "language", "n")]

    columns = [*names, "grams", "likelihoods", "fit"]
    schema = "id long, key long, declared string, host string, suffix string, grams long, likelihoods array<double>, fit double"
    if model.count() <= sent:
        held = arrays(model.toArrow())

        def score(batches):
            counts = Counts(*held, len(sizes))
            for batch in batches:
                yield pa.record_batch(judged(batch, counts), columns)

        return rows.mapInArrow(score, schema)

    def wanted(batches):
        for batch in batches:
            units = batch.column(0).to_numpy()
            for first, _, data, offsets in text_slices(batch.column(1)):
                codes, row = _row_codes(data, offsets)
                of = units[first + row]
                for unit in np.unique(of):
                    seen = np.unique(codes[of == unit])
                    yield pa.record_batch([pa.array(np.full(len(seen), unit)), pa.array(seen)], ["unit", "gram"])

    def score_block(texts: pa.Table, counted: pa.Table) -> pa.Table:
        return pa.table(judged(texts, Counts(*arrays(counted), len(sizes))), columns)

    dealt = scratch.settle(in_blocks(rows, ["text"], BLOCK_ROWS, BLOCK_BYTES), "blocks")
    needs = scratch.settle(dealt.select("unit", "text").mapInArrow(wanted, "unit long, gram int").distinct(), "wanted")
    hot = model.groupBy("gram").agg(F.sum("n").alias("all")).where(F.col("all") > float(sizes.sum()) / HOT_SHARE).select("gram")
    often = model.join(F.broadcast(hot), "gram")
    # at most HOT_SHARE trigrams are that hot; their counts by language are joined by what Spark sees of their size
    counted = needs.join(often, "gram").unionByName(needs.join(model.join(F.broadcast(hot), "gram", "left_anti"), "gram"))
    return dealt.groupBy("unit").cogroup(counted.groupBy("unit")).applyInArrow(score_block, schema)


def _strings(values: list[str]) -> Column:
    return F.split(F.lit(",".join(values)), ",")


def _numbers(values: np.ndarray) -> Column:
    """An array as one literal, however many languages there are."""
    return F.split(F.lit(",".join(repr(float(x)) for x in values)), ",").cast("array<double>")


def _fits_some(scored: DataFrame, languages: list[str], random: np.ndarray) -> Column:
    """Whether the fit reaches the floor of the row's vote. Medians are over all rows that declare the language they vote for.

    A text without trigrams, and one whose language has no such rows, has nothing to be held against and passes.
    """
    voted = F.element_at(_strings(languages), F.col("vote") + 1)
    sure = scored.where(F.col("grams") > 0).where(voted == F.col("declared"))
    typical = np.full(len(languages), np.nan)
    for r in sure.groupBy("vote").agg(F.percentile_approx("fit", 0.5, 10_000).alias("median")).collect():
        typical[r.vote] = r.median
    own = F.element_at(_numbers(typical), F.col("vote") + 1)
    gap = F.element_at(_numbers(np.maximum(typical - random, 0.0)), F.col("vote") + 1)
    floor = own - gap * (LEAST_FIT + 1 / F.sqrt("grams"))
    return (F.col("grams") == 0) | F.isnan(own) | (F.col("fit") >= floor)


def _best(scores: Column) -> Column:
    """Position of the largest score, the first of equal ones."""
    return F.array_position(scores, F.array_max(scores)).cast("int") - 1


def _by_language(votes: DataFrame, column: str, many: int) -> DataFrame:
    """(column, c): votes of each value by language, as an array."""
    counts = votes.where(F.col(column).isNotNull()).groupBy(column, "vote").agg(F.sum("n").alias("n"))
    pairs = counts.groupBy(column).agg(F.map_from_entries(F.collect_list(F.struct("vote", "n"))).alias("m"))
    counted = F.transform(F.sequence(F.lit(0), F.lit(many - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0)).cast("double"))
    return pairs.select(column, counted.alias("c"))


def _all(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + x)


def _per_language(votes: DataFrame, many: int) -> np.ndarray:
    out = np.zeros(many)
    for vote, n in votes.groupBy("vote").agg(F.sum("n").alias("n")).collect():
        out[vote] = n
    return out


def _given(votes: DataFrame, column: str, many: int, name: str) -> DataFrame:
    """(column, name): log P(value | language) of each value of a column."""
    votes = votes.where(F.col(column).isNotNull())
    whole = _per_language(votes, many)
    values = votes.select(column).distinct().count()
    share = SMOOTHING * (_all(F.col("c")) + 1) / (float(whole.sum() or 1.0) + values)
    chance = F.zip_with("c", _numbers(whole + SMOOTHING), lambda c, w: F.log((c + share) / w))
    return _by_language(votes, column, many).select(column, chance.alias(name))


def _sum(*arrays: Column) -> Column:
    out = arrays[0]
    for more in arrays[1:]:
        out = F.zip_with(out, more, lambda a, b: a + b)
    return out


def _priors(votes: DataFrame, many: int) -> tuple[DataFrame, np.ndarray]:
    """(host, prior): log prior of each language, from votes of the host, its domain (last two labels) and all; the prior of all."""
    base = _per_language(votes, many) + 1.0
    base /= base.sum()
    domain = F.substring_index("host", ".", -2)
    hosts = _by_language(votes, "host", many).withColumn("domain", domain)
    domains = _by_language(votes.withColumn("domain", domain), "domain", many).withColumnRenamed("c", "d")
    smooth = F.zip_with("d", _numbers(base), lambda d, b: (d + SMOOTHING * b) / (_all(F.col("d")) + SMOOTHING))
    prior = F.zip_with("c", smooth, lambda c, x: F.log((c + SMOOTHING * x) / (_all(F.col("c")) + SMOOTHING)))
    return hosts.join(domains, "domain").select("host", prior.alias("prior")), np.log(base)


def _evidence(scored: DataFrame, votes: DataFrame, many: int, scratch: Scratch) -> DataFrame:
    """(declared, host, suffix, evidence): the three other kinds of evidence, added up for each combination that occurs."""
    priors, base = _priors(votes, many)
    combined = scratch.settle(scored.select("declared", "host", "suffix").distinct(), "combinations")
    for column, name in (("declared", "says"), ("suffix", "ends")):
        combined = combined.join(scratch.settle(_given(votes, column, many, name), name), column, "left")
    combined = combined.join(scratch.settle(priors, "priors"), "host", "left")
    nothing = _numbers(np.zeros(many))
    total = _sum(F.coalesce("says", nothing), F.coalesce("ends", nothing), F.coalesce("prior", _numbers(base)))
    return scratch.settle(combined.select("declared", "host", "suffix", total.alias("evidence")), "evidence")


def markup_language(html: Column) -> Column:
    """The language that a page's markup declares: lang of its html element, else its content-language."""
    of_html = F.regexp_extract(html, r"(?i)<html\b[^>]*?[\s:]lang\s*=\s*[\"']?\s*([a-z]+(?:[-_][a-z0-9]+)*)", 1)
    of_meta = F.regexp_extract(html, r"(?i)<meta\b[^>]*?content-language[\"']?\s+content\s*=\s*[\"']?\s*([a-z]+(?:[-_][a-z0-9]+)*)", 1)
    return F.coalesce(F.nullif(of_html, F.lit("")), F.nullif(of_meta, F.lit("")))


def suffix_of(host: Column) -> Column:
    """The last label of a host that has a dot and is no number (of an address like 10.0.0.1), without a port; else null."""
    return F.nullif(F.regexp_extract(host, r"\.([^.:0-9][^.:]*)\.?(?::\d*)?$", 1), F.lit(""))


def languages_of_pages(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", **kwargs) -> DataFrame:
    """``languages_of`` the main texts of pages: the language declared in the markup, host and suffix from the url.

    A null page, or one without a main text, is judged as an empty text; null urls and such without a host say nothing.
    """

    def read(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                page = batch.slice(n, 1)
                yield pa.record_batch([*page.columns[:3], pa.array([main_text(page.column(3)[0].as_py())], pa.string())], ["id", "declared", "host", "text"])

    scratch = Scratch(pages.sparkSession, "page-texts")
    html = F.col(html_column).cast("string")
    rows = pages.select(
        F.col(id_column).cast("long").alias("id"), markup_language(html).alias("declared"),
        host_of(F.col(url_column).cast("string")).alias("host"), html.alias("html"),
    )
    texts = scratch.settle(rows.mapInArrow(read, "id long, declared string, host string, text string"), "texts")
    found = languages_of(texts, "id", declared=F.col("declared"), host=F.col("host"), suffix=suffix_of(F.col("host")), **kwargs)
    return found.withColumnRenamed("id", id_column)


def languages_of(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    declared: Column | None = None,
    host: Column | None = None,
    suffix: Column | None = None,
    accept: list[str] | None = None,
    least_confidence: float = 0.5,
) -> DataFrame:
    """(id, declared, language, confidence, accepted, fit, contradicted, row_key) of every row.

    ``declared`` is the language that markup or metadata declares (lower-cased, up to the first - or _), ``host`` and
    ``suffix`` where the text comes from; each may be null or left out and then says nothing. What is no language code
    (two or three letters) declares nothing. The languages are all those declared. A row is accepted if its language is one of ``accept`` (any, if
    None) and its posterior is at least ``least_confidence``.

    A text out of language (foreign, gibberish) has a null language and is not accepted, whatever it declares and wherever it
    comes from; ``fit`` tells by how much, and its vote counts for nothing. ``contradicted``: the row declares one of
    the languages and is judged to be in another or in none.

    A text of fewer than three bytes (null and empty ones too) is judged by the rest of the evidence; without any letter
    in it, its language is null and it is not accepted. Every row is judged by itself: repeated rows come out repeated.
    Without any declared language nothing can be learned: every language is null. Ties go to the first in the alphabet.
    row_key (xxhash64 of text, declared language and host) tells rows of one id apart.
    """
    scratch = Scratch(docs.sparkSession, "language")
    nothing = F.lit(None).cast("string")
    said = nothing if declared is None else F.regexp_extract(F.lower(declared.cast("string")), CODE, 1)
    origin = nothing if host is None else host.cast("string")
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.xxhash64(F.col(text_column), *([declared] if declared is not None else []), *([host] if host is not None else [])).alias("key"),
        F.when(said != "", said).alias("declared"),
        origin.alias("host"),
        (nothing if suffix is None else suffix.cast("string")).alias("suffix"),
        F.col(text_column).cast("string").alias("text"),
    )
    languages = sorted(row.declared for row in rows.where("declared is not null").select("declared").distinct().collect())
    empty = "id long, declared string, language string, confidence double, accepted boolean, fit double, contradicted boolean, row_key long"
    if not languages:
        return rows.selectExpr("id", "declared", "cast(null as string) language", "0D confidence", "false accepted", "cast(null as double) fit", "false contradicted", "key row_key").to(
            docs.sparkSession.createDataFrame([], empty).schema
        ).withColumnRenamed("id", id_column)
    many = len(languages)
    model = scratch.settle(gram_counts(rows, languages), "counts")
    sizes = np.zeros(many)
    for language, n in model.groupBy("language").agg(F.sum("n").alias("n")).collect():
        sizes[language] = n
    sizes += 0.5 * (model.select("gram").distinct().count() + 1)
    lettered = F.col("text").rlike(r"\p{L}")
    scored = _likelihoods(rows.where(F.coalesce(lettered, F.lit(False))), model, languages, sizes, scratch).withColumn("vote", _best(F.col("likelihoods")))
    blank = rows.where(~F.coalesce(lettered, F.lit(False))).select(
        "id", "declared", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("accepted"),
        F.lit(None).cast("double").alias("fit"), F.lit(False).alias("contradicted"), F.col("key").alias("row_key"),
    )
    scored = scratch.settle(scored, "likelihoods")
    scored = scored.withColumn("fits", _fits_some(scored, languages, np.log(0.5 / sizes)))
    votes = scored.where("grams > 0 and fits").groupBy("vote", "declared", "host", "suffix").agg(F.count(F.lit(1)).alias("n"))
    votes = scratch.settle(votes, "votes")
    evidence = _evidence(scored, votes, many, scratch)
    # rows of one origin are spread over SALTS keys; the evidence is repeated for each
    salted = evidence.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).alias("e")
    salt = F.pmod(F.xxhash64("id", "key"), F.lit(SALTS)).cast("int")
    same = F.col("s.salt") == F.col("e.salt")
    for column in ("declared", "host", "suffix"):
        same = same & F.col(f"s.{column}").eqNullSafe(F.col(f"e.{column}"))
    joined = scored.withColumn("salt", salt).alias("s").join(salted, same).select("s.*", "evidence")
    fit = F.when(F.col("grams") > 0, F.col("fit")).alias("fit")
    posterior = joined.select("id", "key", "declared", "fits", fit, _sum(F.col("likelihoods"), F.col("evidence")).alias("p"))
    best = F.array_max("p")
    share = 1 / F.aggregate("p", F.lit(0.0), lambda a, x: a + F.exp(x - best))
    named = posterior.select(
        "id", "key", "declared", "fit", "fits",
        F.when(F.col("fits"), F.element_at(_strings(languages), _best(F.col("p")) + 1)).alias("language"),
        F.when(F.col("fits"), share).otherwise(0.0).alias("confidence"),
    )
    wanted = F.lit(True) if accept is None else F.coalesce(F.col("language").isin(accept), F.lit(False))
    other = F.col("declared").isNotNull() & ~F.col("language").eqNullSafe(F.col("declared"))
    judged = named.select(
        "id", "declared", "language", "confidence", (F.col("fits") & wanted & (F.col("confidence") >= least_confidence)).alias("accepted"),
        "fit", F.coalesce(other, F.lit(False)).alias("contradicted"), F.col("key").alias("row_key"),
    )
    return judged.unionByName(blank).withColumnRenamed("id", id_column)
