"""Language identification by Bayesian evidence fusion.

For each language L the posterior combines four kinds of evidence, as log terms:

* the text: naive Bayes over hashed byte trigrams, tempered so that a long text weighs
  like ``EVIDENCE`` trigrams (neighbouring trigrams are not independent);
* the declared language (markup ``lang``, a metadata column): P(declared | L);
* the address suffix (last label of the host): P(suffix | L);
* the host: P(L | host), smoothed towards its domain (last two labels), and that towards
  the whole corpus.

The last three are estimated from the corpus itself: a first pass sums the text
posteriors by (declared, host), with map-side combine, so a host with a third of all rows
is one partial sum a task; suffixes, domains and the corpus are sums of those sums. Each
row's scores then meet its evidence (see ``identify`` for what moves). A
class ``und`` with equal odds for all trigrams takes texts that fit no language.

The trigram model is fitted on a bounded sample: about ``sample_rows`` different labelled
texts with letters, whole, chosen by hash; rare labels give all of theirs and the others
equal shares of the rest, so that every label is a class, up to the ``MAX_LANGUAGES`` most
frequent ones (other labels stay declared values). Everything else covers all rows.

Null and letterless texts are ``und`` with confidence 0. A null declaration, host or address
is a value like any other. Rows repeat as they come; other columns are carried unchanged,
also if named like those used here. Ties go to the language first by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded_batches, broadcast_if_small, kept_in_worker, stage

UND = "und"
BUCKETS = 1 << 15
EVIDENCE = 200.0
SAMPLE_ROWS = 8_000
MAX_LANGUAGES = 200
PRIOR_BYTES = 32 << 20  # of priors that are broadcast
SMOOTHING = 20.0  # pseudo-rows that a parent lends to its child
_LETTERS = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def trigram_blocks(text: str | None, block: int = 1 << 18) -> Iterator[np.ndarray]:
    """Buckets of the byte trigrams of the lower-cased words, ``block`` characters at a time (so
    the memory taken does not grow with the text); none for a text without letters."""
    text, tail, words = text or "", b" ", False
    for at in range(0, len(text), block):
        raw = text[at:at + block].lower().encode("utf-8", "replace").translate(_LETTERS)
        piece = b" ".join(raw.split())
        words = words or bool(piece)
        before = b" " if raw[:1] == b" " and tail[-1:] != b" " else b""
        after = b" " if piece and raw[-1:] == b" " else b""
        piece = tail + before + piece + after
        if at + block >= len(text) and words and piece[-1:] != b" ":
            piece += b" "
        tail = piece[-2:]
        b = np.frombuffer(piece, np.uint8).astype(np.uint32)
        if words and len(b) > 2:
            yield ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761) >> np.uint32(17)).astype(np.int64)


def trigrams(text: str | None) -> np.ndarray:
    """All of ``trigram_blocks`` at once."""
    return np.concatenate([np.empty(0, np.int64), *trigram_blocks(text)])


class TextModel:
    """log P(trigram | language), one column a language, ``und`` last."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = [*languages, UND]
        odds = (counts + 0.5) / (counts + 0.5).sum(axis=0, keepdims=True)
        self.logs = np.log(np.concatenate((odds, np.full((BUCKETS, 1), 1 / BUCKETS)), axis=1))

    def likelihood(self, text: str | None) -> tuple[np.ndarray, int]:
        """Tempered log-likelihoods and the number of trigrams."""
        total, n = np.zeros(len(self.languages)), 0
        for found in trigram_blocks(text):
            n += len(found)
            if len(found) < BUCKETS >> 3:
                total += self.logs.take(found, axis=0).sum(axis=0)
            else:  # as many operations as there are buckets, however many trigrams
                total += np.bincount(found, minlength=BUCKETS) @ self.logs
        return total * (min(n, EVIDENCE) / max(n, 1)), n


def fit_text_model(labelled: DataFrame, text_col: str = "text", label_col: str = "lang",
                   sample_rows: int = SAMPLE_ROWS) -> TextModel:
    """Trigram counts by language over a hash-chosen sample of the labelled texts."""
    share = 1 << 40
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label")).dropna()
    rows = rows.filter(F.col("text").rlike(r"[A-Za-z]|[^\x00-\x7F]")).withColumn("key", F.pmod(F.xxhash64("text"), F.lit(share)))
    sizes = rows.select("label", "key").distinct().groupBy("label").agg(
        F.count("*").alias("n"), F.min("key").alias("least"))
    sizes = sizes.orderBy(F.desc("n"), "label").limit(MAX_LANGUAGES).collect()
    cuts, left = [], sample_rows
    for i, (label, n, least) in enumerate(sorted(sizes, key=lambda r: (r["n"], r["label"]))):
        take = max(1, min(n, left // (len(sizes) - i)))
        cuts.append((label, share if take == n else max(share * take // n, least + 1)))
        left = max(0, left - take)
    side = F.broadcast(labelled.sparkSession.createDataFrame(cuts, "label string, cut long"))
    sample = rows.join(side, "label").filter("key < cut").groupBy("label", "key").agg(F.first("text").alias("text"))
    sample = sample.select("text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, label in zip(map(_plain, batch.column(0)), batch.column(1).to_pylist(), strict=True):
                own = sums.setdefault(label, np.zeros(BUCKETS, np.int64))
                for block in trigram_blocks(text):
                    own += np.bincount(block, minlength=BUCKETS)
        for label, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(at), pa.string()), pa.array(at), pa.array(own[at])], ["label", "bucket", "n"])

    found = (sample.mapInArrow(run, "label string, bucket long, n long")
             .groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas())  # at most BUCKETS rows a language
    languages = sorted(found["label"].unique())
    counts = np.zeros((BUCKETS, len(languages)))
    for i, language in enumerate(languages):
        own = found[found["label"] == language]
        counts[own["bucket"], i] = own["n"]
    return TextModel(languages, counts)


def host_of(url: Column) -> Column:
    """The lower-cased host of an address; empty for none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]*://([^/?#]*)", 1))


def markup_text(html: Column) -> Column:
    """The words of a page, roughly: no scripts, styles, comments, tags or references."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&\w+;", " ")


def markup_language(html: Column) -> Column:
    """The language that the html element declares; null if none."""
    found = F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]+)""", 1))
    return F.when(found != "", found)


def _evidence(sums: DataFrame, k: int) -> DataFrame:
    """(declared, host, prior): the log prior of each pair that occurs, from the sums p0..pk-1 of
    text posteriors by (declared, host)."""
    p = [f"p{i}" for i in range(k)]

    def summed(*by: str) -> DataFrame:
        out = sums.groupBy(*by).agg(*[F.sum(c).alias(c) for c in p])
        return out.select(*by, F.array(*p).alias("_".join(("of", *by))))

    total = sums.agg(*[F.sum(c).alias(c) for c in p]).first()
    mass = [float(total[c] or 0.0) for c in p]
    world = F.array(*[F.lit((m + 1) / (sum(mass) + k)) for m in mass])
    size = F.array(*[F.lit(m) for m in mass])
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    smooth = lambda own, parent: F.zip_with(
        own, parent, lambda x, q: (x + SMOOTHING * q) / (add(own) + SMOOTHING))
    # P(value | L), as (n(value, L) + 1) / (n(L) + 20): equal odds for all L unless the corpus says more
    given = lambda own: F.zip_with(own, size, lambda x, m: (x + 1.0) / (m + SMOOTHING))
    out = sums.select("declared", "host", "domain", "suffix")
    for by in ("declared", "suffix", "domain", "host"):
        side = summed(by)
        out = out.join(broadcast_if_small(side), out[by].eqNullSafe(side[by])).drop(side[by])
    out = out.withColumn("of_domain", smooth(F.col("of_domain"), world))
    out = out.withColumn("of_host", smooth(F.col("of_host"), F.col("of_domain")))
    terms = F.arrays_zip(given(F.col("of_declared")).alias("d"), given(F.col("of_suffix")).alias("s"),
                         F.col("of_host").alias("h"))
    return out.select("declared", "host", F.transform(
        terms, lambda t: F.log(t["d"]) + F.log(t["s"]) + F.log(t["h"])).alias("prior"))


def _plain(value: pa.Scalar) -> str | None:
    return value.as_py()


def _scores(model: TextModel, text: Column) -> Column:
    """The tempered log-likelihoods of a text by language; null for a letterless one. Only the
    text goes to Python, and only these numbers come back."""
    @F.arrow_udf("array<double>")
    def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept_in_worker()
        for column in columns:
            found = [model.likelihood(_plain(t)) for t in column]
            yield pa.array([x if n else None for x, n in found], pa.list_(pa.float64()))
    return scores(text)


def _odds(scores: Column) -> Column:
    """e to the scores, the highest as 1."""
    top = F.array_max(scores)
    return F.transform(scores, lambda x: F.exp(x - top))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def identify(df: DataFrame, model: TextModel, text: Column, declared: Column, host: Column,
             carried: list[str] | None = None) -> DataFrame:
    """(row: the ``carried`` columns of ``df`` as a struct, language, confidence) for every row of
    ``df``. With all columns carried (None) each text is scored in both passes, and rows move
    only if the evidence is too large to broadcast. With some (``carried``, for tables whose
    texts are not needed again) rows of scores are staged, and no text ever moves."""
    names, k = model.languages, len(model.languages)
    bounded_batches(df.sparkSession)
    own = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carried is None else carried)])
    scored = df.select(own.alias("row"), declared.alias("declared"), host.alias("host"), _scores(model, text).alias("scores"))
    if carried is not None:
        scored = stage(scored, "language-scores")
    odds = scored.select("declared", "host", _odds(F.col("scores")).alias("odds"))
    odds = odds.select("declared", "host", "odds", _total(F.col("odds")).alias("all"))
    sums = odds.groupBy("declared", "host").agg(
        *[F.coalesce(F.sum(F.col("odds")[i] / F.col("all")), F.lit(0.0)).alias(f"p{i}") for i in range(k)])
    sums = stage(sums.withColumn("domain", F.substring_index("host", ".", -2))
                 .withColumn("suffix", F.substring_index("host", ".", -1)), "language-sums")
    prior = stage(_evidence(sums, k), "language-priors")
    prior = broadcast_if_small(prior.withColumnsRenamed({"declared": "declared_", "host": "host_"}),
                               limit=min(BROADCAST_ROWS, PRIOR_BYTES // (8 * k + 100)))
    beside = scored.join(prior, F.col("declared").eqNullSafe(F.col("declared_"))
                         & F.col("host").eqNullSafe(F.col("host_")), "left")
    fused = beside.select("row", F.zip_with("scores", "prior", lambda x, q: x + q).alias("fused"))
    best = F.array_position("fused", F.array_max("fused"))
    sure = F.round(1.0 / _total(_odds(F.col("fused"))), 6)
    return fused.select("row", F.coalesce(F.element_at(F.array(*map(F.lit, names)), best.cast("int")), F.lit(UND)).alias("language"),
                        F.coalesce(sure, F.lit(0.0)).alias("confidence"))


def accepted(least: float = 0.5, wanted: list[str] | None = None) -> Column:
    """Whether a row of ``identify`` is in a wanted (default: any known) language, surely enough."""
    known = F.col("language") != UND if wanted is None else F.col("language").isin(wanted)
    return known & (F.col("confidence") >= least)


def identify_pages(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """id, url, declared, host, language, confidence, accepted of every page."""
    html = F.col(html_col)
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"),
                       markup_language(html).alias("said"), host_of(F.col(url_col)).alias("host"))
    out = identify(own, model, markup_text(F.col("html")), F.col("said"), F.col("host"), ["id", "url", "said", "host"])
    return out.select(F.col("row.id").alias(id_col), F.col("row.url").alias(url_col), F.col("row.said").alias("declared"),
                      F.col("row.host").alias("host"), "language", "confidence", accepted().alias("accepted"))


def keep_identified(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                    least: float = 0.5, wanted: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` in a wanted language, with their columns. The language column is the
    declaration and labels the model's sample; the source stands for the host."""
    model = fit_text_model(docs, text_col, lang_col)
    out = identify(docs, model, F.col(text_col), F.col(lang_col).cast("string"), F.col(source_col).cast("string"))
    return out.filter(accepted(least, wanted)).select("row.*")
