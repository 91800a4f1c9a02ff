import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.llm import bpe, catalog, language, surrogates

from .conftest import ODD_ROWS


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_tokenizer())


@pytest.fixture(scope="module")
def vocabulary():
    with open(bpe.default_tokenizer(), encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_documents_as_the_library_encodes_them(spark, sf_dir, texts, library):
    rows = catalog.op7_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected(library, texts[r["doc_id"]]) for r in rows)


def test_odd_rows_bpe(odd, none, library):
    codec = bpe.Codec(odd)
    rows = codec.round_trip(odd).collect()
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == sorted(expected(library, t or "") for _, t, *_ in ODD_ROWS)
    back = codec.decode(codec.encode(odd)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter((d, t or "") for d, t, *_ in ODD_ROWS)
    assert bpe.Codec(none).round_trip(none).count() == 0


def test_any_text_as_the_library_encodes_it(library, vocabulary):
    random.seed(3)
    known = ["the", " the", " of", "ing", " thing", "é", "\n"]
    encoder = bpe.Encoder(vocabulary, bpe.Lexicon(bpe.compile_lexicon({w.encode(): vocabulary.merge(w.encode()) for w in known})))
    odd = "ab \n\t\r\x0b\x0c\x1c\x1f\x85\xa0᠎​　é東١Ⅷ½ªµ×ñÿ'sd!<|_😀́\x00﻿"
    texts = ["".join(random.choice(odd) for _ in range(random.randint(0, 40))) for _ in range(1500)]
    texts += [t + "<|endoftext|>" + t for t in texts[:50]] + ["x" * 3000, "the" * 1500, " " * 900 + "x", "東" * 700]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_lexicon_is_minimal_and_exact():
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops", "s", "東京"])}
    compiled = bpe.compile_lexicon(words)
    lexicon = bpe.Lexicon(compiled)
    assert all(np.frombuffer(lexicon.find(w), "<u4").tolist() == ids for w, ids in words.items())
    assert [lexicon.find(w) for w in (b"", b"t", b"ta", b"topsy", b"x", "東".encode())] == [None] * 6
    # The states are the distinct sets of endings.
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes}
    assert len(lexicon.final) == len(endings)


def test_frequent_pieces_are_counted_over_all_texts(docs, texts):
    n = Counter(p for t in texts.values() for p in bpe.cut(t))
    found = bpe.frequent_pieces(docs, [], 100)
    border = min(n[p] for p in found)
    assert set(found) == {p for p, c in n.items() if c >= border} and len(found) <= 100
    assert len(found) + sum(c == max((x for x in n.values() if x < border)) for c in n.values()) > 100


def test_languages_of_pages(spark, sf_dir):
    truth = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.regexp_extract("url", r"//[^/]+/(\w+)/", 1).alias("truth"))
    rows = catalog.op3_language(spark, sf_dir).join(truth, "page_id").collect()
    assert len(rows) == truth.count() and np.mean([r["lang"] == r["truth"] for r in rows]) >= 0.98


def plain_fusion(pages, n, s=language.SMOOTHING):
    p = []
    for page in pages:
        e = [math.exp(x) for x in page["loglik"]]
        p.append([x / sum(e) for x in e])
    out = []
    for i, page in enumerate(pages):
        def sums(key):
            return [sum(p[j][k] for j in range(len(pages)) if j != i and (key is None or pages[j][key] == page[key])) for k in range(n)]

        prior = [1 / n] * n
        for key in (None, "domain", "host"):
            held = sums(key) if key is None or page[key] is not None else [0.0] * n
            prior = [(a + s * c) / (sum(held) + s) for a, c in zip(held, prior)]
        score = [x + math.log(y) for x, y in zip(page["loglik"], prior)]
        whole = sums(None)
        for key in ("declared", "suffix"):
            if page[key] is not None:
                score = [x + math.log((a + s / n) / (b + s)) for x, a, b in zip(score, sums(key), whole)]
        e = [math.exp(x - max(score)) for x in score]
        out.append([x / sum(e) for x in e])
    return out


def test_fusion_by_hand(spark):
    rng = random.Random(5)
    pages = [
        {"page_id": i, "host": h and f"{h}.x.org", "domain": h and "x.org", "suffix": h and rng.choice(["org", "de"]), "declared": rng.choice([None, "de", "en"]),
         "loglik": [-rng.random() * 4, -rng.random() * 4, 0.0]}
        for i, h in enumerate([None, "a", "a", "a", "b", "b", "c", "a", "c", None])
    ]
    schema = "page_id long, host string, domain string, suffix string, declared string, loglik array<double>"
    rows = language.fuse(spark.createDataFrame([tuple(q.values()) for q in pages], schema), ["de", "en", "fr"]).collect()
    for r in rows:
        best = plain_fusion(pages, 3)[r["page_id"]]
        assert math.isclose(r["posterior"], max(best), rel_tol=1e-9) and r["lang"] == ["de", "en", "fr"][best.index(max(best))]


def test_odd_pages(spark, docs, none):
    rows = [(1, None, None), (1, None, None), (None, "http://[bad", ""), (2, "", "<p>x"), (3, "https://a.b.de/x", "<html lang=DE-at><script>the the</script>" + "<b>" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("p", F.lit("clash"))
    found = language.identify(pages, docs).collect()
    assert len(found) == 5 and all(r["lang"] is not None for r in found)
    assert [r["declared"] for r in found if r["page_id"] == 3] == ["de"]
    assert language.identify(pages, none).count() == 0
    assert language.identify(pages.limit(0), docs).count() == 0
    assert language.visible_text("<nav>menu</nav><article>A &amp; <b>b</b><!-- c --></article> d").split() == ["A", "&", "b"]


def test_personal_data_of_documents(spark, sf_dir, texts):
    rows = {r["doc_id"]: r for r in catalog.op10_surrogates(spark, sf_dir).collect()}
    assert set(rows) == set(texts)
    seen = {}
    for d, text in texts.items():
        found = list(surrogates.mentions(text))
        assert rows[d]["n_replaced"] == len(found)
        if not found:
            assert rows[d]["text"] == text
        after = list(surrogates.mentions(rows[d]["text"]))
        assert [m[2] for m in after] == [m[2] for m in found]
        for (_, _, k, old), (_, _, _, new) in zip(found, after):
            assert old not in rows[d]["text"] and len(old) == len(new)
            seen.setdefault((k, surrogates.canonical(k, old)), set()).add((k, surrogates.canonical(k, new)))
    # One surrogate for each entity, another for each other entity, none a real one.
    assert all(len(v) == 1 for v in seen.values())
    made = [next(iter(v)) for v in seen.values()]
    assert len(set(made)) == len(made) and not set(made) & set(seen)


def test_formats_of_surrogates():
    text = ("Mail ünd.34@mail7.example.com, ÜND.34@MAIL7.EXAMPLE.COM; +1 (017) 555-7713, +1 017 555 7713; 4539578763621486 or 4539 5787 6362 1486; "
            "97.51.17.173; token = \"9b0b3c6a43eb78aa99cbd7049c572391524f37a8\"; Frau Müller, Mr. John Smith, Госпожа Иванова; v2.0 in 2024")  # fmt: skip
    out, last = [], 0
    for a, b, k, m in surrogates.mentions(text):
        form = surrogates.canonical(k, m)
        out.append((k, m, surrogates.written(k, m, surrogates.surrogate(b"k", k, form))))
    kinds = [k for k, *_ in out]
    assert kinds == ["email", "email", "phone", "phone", "card", "card", "ip", "secret", "name:f:LATIN", "name:m:LATIN", "name:f:CYRILLIC"]
    new = [n for *_, n in out]
    assert new[0].upper() == new[1] and new[2][:2] == "+1" and [c for c in new[2] if c.isdigit()] == [c for c in new[3] if c.isdigit()]
    assert surrogates.luhn(new[4]) and new[5].replace(" ", "") == new[4] and new[4][0] == "4"
    assert len(new[7]) == 40 and set(new[7]) <= set("0123456789abcdef")
    assert new[9].split()[0] in surrogates.FIRST["m", "LATIN"] and surrogates.script(new[10][0]) == "CYRILLIC"
    assert all(m != n for _, m, n in out)


def test_collisions_are_drawn_again(spark):
    # More family names than the list holds: distinct entities must still end up distinct.
    names = [f"Mr {chr(65 + i % 26)}{'abcdefghij'[i // 26]}son" for i in range(150)]
    df = spark.createDataFrame([(i, f"We met {n} and {n}.") for i, n in enumerate(names)], "doc_id long, text string")
    rows = surrogates.replace_personal_data(df, b"k").collect()
    made = [r["text"].split(" and ") for r in rows]
    first = [m[0].split("Mr ")[1] for m in made]
    assert len(set(first)) == 150 and all(m[0].split("Mr ")[1] == m[1].split("Mr ")[1].rstrip(".") for m in made)


def test_odd_rows_surrogates(odd, none):
    rows = surrogates.replace_personal_data(odd, b"k").collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((d, t) for d, t, *_ in ODD_ROWS) and all(r["n_replaced"] == 0 for r in rows)
    assert surrogates.replace_personal_data(none, b"k").count() == 0


def test_more_languages_than_have_models(spark):
    """300 values of ``lang``: the largest keep their own model, the rest is one class, and pages get a result."""
    rows = [(f"l{i:03d}", "the of and to " * (400 - i)) for i in range(300)] + [(None, "x")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    languages, shares = language.text_model(docs)
    assert languages == sorted([f"l{i:03d}" for i in range(255)] + [language.OTHER]) and shares.shape[0] == 256
    assert language.text_model(docs.where("lang < 'l256'"))[0] == [f"l{i:03d}" for i in range(256)]
    pages = spark.createDataFrame([(1, "http://a.de/x", "<html lang='l007'><p>the of and to</p></html>"), (2, None, None)], "page_id long, url string, html string")
    few = docs.where("lang < 'l004'")
    kept = language.MOST
    language.text_model.__defaults__ = (3,)
    try:
        found = language.identify(pages, few).collect()
        assert language.text_model(few)[0] == ["l000", "l001", language.OTHER] and len(found) == 2 and all(r["lang"] for r in found)
    finally:
        language.text_model.__defaults__ = (kept,)
