"""Language identification by Bayesian evidence fusion.

For each page the posterior of a language multiplies
* the likelihood of its text: hashed byte trigrams, counted per language over all documents with a language; the log-likelihood is tempered, since
  neighbouring trigrams are not independent;
* the likelihood of the language declared in the markup, and of the suffix of its address, given the language;
* a prior of its host, smoothed towards its domain, which is smoothed towards all pages.

The tables of declared languages, suffixes, hosts, domains and the whole are sums of the text posteriors by grouped aggregation over
all pages; a page's own contribution is taken out before it is judged. Sums are combined in each task, so a host with a third
of all pages is a few rows.

A page without text has equal text likelihoods and is decided by the rest; a missing address or declaration says nothing. Ties go to the first language by
code point. Null and repeated ids change nothing. With no labelled document, or no page, the result is empty. Beyond ``MOST`` languages the smaller ones share one class.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.tables import kind
from zonecast.llm.text import encoded, slices
from zonecast.session import materialize

BUCKETS = 1 << 13
#: Weight of one trigram's evidence.
TEMPER = 0.25
#: Pages' worth of belief in the coarser level, and in an even spread of declarations and suffixes.
SMOOTHING = 4.0
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32

_DROPPED = re.compile(r"(?is)<(script|style|nav|aside|footer|header|noscript|template)\b.*?</\1\s*>|<!--.*?-->")
_MAIN = re.compile(r"(?is)<(article|main)\b[^>]*>(.*?)</\1\s*>")
_TAG = re.compile(r"(?s)<[^>]*>")
_DECLARED = re.compile(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b")


def visible_text(html: str) -> str:
    """The main text of a page: its article where there is one, without scripts, menus and tags."""
    bare = _DROPPED.sub(" ", html)
    main = [m[2] for m in _MAIN.finditer(bare)]
    return unescape(_TAG.sub(" ", " ".join(main) if main else bare))


def trigrams(text: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of letters and spaces, lower-cased; digits and signs break them."""
    b = _FOLD[np.frombuffer(text, np.uint8)]
    if len(b) < 3:
        return np.zeros(0, np.int64)
    good = (b == 32) | ((b >= 97) & (b <= 122)) | (b >= 128)
    held = good[:-2] & good[1:-1] & good[2:]
    code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:])[held]
    return ((code * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch, texts in slices(batches):
        langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        for lang, text in zip(langs, texts):
            sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
            sums[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
    for lang, n in sums.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "bucket", "n"])


#: Languages with a model of their own, and the class that all others share beyond that number.
MOST, OTHER = 256, "other"


def text_model(docs: DataFrame, most: int = MOST) -> tuple[list[str], np.ndarray]:
    """Languages and their log trigram shares, from all documents with a language.

    If there are more than ``most``, those with most trigrams (then the first by name) stand for themselves, and all others are one class, ``OTHER``.
    """
    counts = materialize(docs.where(F.col("lang").isNotNull()).select("lang", "text").mapInArrow(_counted, "lang string, bucket long, n long"), "trigrams")
    ranked = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(most + 1).collect()
    lang = F.col("lang")
    if len(ranked) > most:
        lang = F.when(lang.isin([r["lang"] for r in ranked[: most - 1]]), lang).otherwise(OTHER)
    table = counts.groupBy(lang.alias("lang"), "bucket").agg(F.sum("n").alias("n")).toPandas()  # most x BUCKETS rows at most
    languages = sorted(table["lang"].unique())
    n = np.full((len(languages), BUCKETS), 0.5)
    n[table["lang"].map({c: i for i, c in enumerate(languages)}).to_numpy(int), table["bucket"].to_numpy(int)] += table["n"].to_numpy()
    return languages, np.log(n / n.sum(axis=1, keepdims=True))


def address(url: str | None) -> tuple[str | None, str | None, str | None]:
    """(host, domain, suffix) of an address."""
    try:
        host = (urlsplit(url or "").hostname or "").rstrip(".")
    except ValueError:
        host = ""
    if not host:
        return None, None, None
    parts = host.split(".")
    return host, ".".join(parts[-2:]), parts[-1] if len(parts) > 1 else None


def _read(shares: np.ndarray, temper: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pages in slices(batches, "html"):
            urls = [u.decode("utf-8", "replace") for u in encoded(batch.column(batch.schema.get_field_index("url")))]
            places = [address(u) for u in urls]
            texts, declared = [], []
            for page in pages:
                html = page.decode("utf-8", "replace")
                found = _DECLARED.search(html)
                declared.append(found[1].lower() if found else None)
                texts.append(visible_text(html).encode())
            scores = np.stack([temper * shares[:, trigrams(t)].sum(axis=1) for t in texts])
            scores -= scores.max(axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("page_id")),
                    *(pa.array([p[i] for p in places], pa.string()) for i in range(3)),
                    pa.array(declared, pa.string()),
                    pa.array(list(scores), pa.list_(pa.float64())),
                ],
                ["page_id", "host", "domain", "suffix", "declared", "loglik"],
            )

    return run


def _sums(pages: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Text posteriors added up per key, as an array."""
    return pages.groupBy(*keys).agg(F.array(*[F.sum(F.col("p")[i]) for i in range(n)]).alias("sums"))


def _with(pages: DataFrame, sums: DataFrame, key: str, n: int) -> DataFrame:
    """Each page with the sums of its key (``<key>_sums``) without its own share; no key: null."""
    named = sums.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col("sums").alias("s"))
    own = F.zip_with("s", "p", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    return pages.join(named, pages[key] == named["k"], "left").withColumn(f"{key}_sums", own).drop("k", "s")


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)


def fuse(pages: DataFrame, languages: list[str], smoothing: float = SMOOTHING) -> DataFrame:
    """The posterior of each page from ``loglik`` and its keys."""
    n = len(languages)
    norm = F.transform("loglik", F.exp)
    pages = pages.withColumn("p", F.transform(norm, lambda x: x / _total(norm)))
    whole = pages.agg(*[F.sum(F.col("p")[i]) for i in range(n)]).first()  # a number per language
    rows = pages
    for key in ("host", "domain", "suffix", "declared"):
        rows = _with(rows, _sums(pages, [key], n), key, n)
    total = F.array(*[F.lit(float(x or 0)) for x in whole])
    rows = rows.withColumn("all_sums", F.zip_with(total, "p", lambda a, b: F.greatest(a - b, F.lit(0.0))))
    even = F.array_repeat(F.lit(1.0 / n), n)

    def smoothed(own: str, coarse: Column) -> Column:
        held = F.coalesce(F.col(own), F.array_repeat(F.lit(0.0), n))
        return F.zip_with(held, coarse, lambda a, c: (a + smoothing * c) / (_total(held) + smoothing))

    rows = rows.withColumn("prior", smoothed("all_sums", even))
    rows = rows.withColumn("prior", smoothed("domain_sums", F.col("prior")))
    rows = rows.withColumn("prior", smoothed("host_sums", F.col("prior")))

    def likelihood(own: str) -> Column:
        # How a declaration or suffix spreads over languages, over how pages do: in proportion to its likelihood.
        even_ = F.zip_with(F.col(own), F.col("all_sums"), lambda a, b: (a + smoothing / n) / (b + smoothing))
        return F.coalesce(even_, F.array_repeat(F.lit(1.0), n))

    logs = [F.col("loglik"), *[F.transform(c, lambda x: F.ln(x)) for c in (F.col("prior"), likelihood("declared_sums"), likelihood("suffix_sums"))]]
    rows = rows.withColumn("score", reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), logs))
    odds = F.transform("score", lambda x: F.exp(x - F.array_max("score")))
    rows = rows.withColumn("odds", odds).withColumn("posterior", F.transform("odds", lambda x: x / _total(F.col("odds"))))
    names = F.array(*[F.lit(c) for c in languages])
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    said = F.array_position("p", F.array_max("p")).cast("int")
    return rows.select(
        "page_id", "host", "declared", "suffix", F.element_at(names, said).alias("text_lang"),
        F.element_at(names, best).alias("lang"), F.array_max("posterior").alias("posterior"),
    )


def identify(pages: DataFrame, docs: DataFrame, temper: float = TEMPER) -> DataFrame:
    """page_id, host, declared, suffix, text_lang, lang and posterior of each page."""
    languages, shares = text_model(docs)
    id_kind = kind(pages, "page_id")
    schema = f"page_id {id_kind}, host string, domain string, suffix string, declared string, loglik array<double>"
    if not languages:
        empty = pages.sparkSession.createDataFrame([], f"page_id {id_kind}, host string, declared string, suffix string, text_lang string, lang string, posterior double")
        return empty
    read = materialize(pages.select("page_id", "url", "html").mapInArrow(_read(shares, temper), schema), "pages")
    return fuse(read, languages)
