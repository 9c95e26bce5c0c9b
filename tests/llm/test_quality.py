import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from tripmill.llm import quality

PATHS = (
    public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
    public_tokenizers.path("piece_bpe_32k.model"),
    public_tokenizers.PATTERN,
)


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered)


@pytest.mark.parametrize(
    "text", ["", " \n\n \n", "a", "a b c a b c a b c", "a b c d a b c", "x\nx\n\n\nx y\nx", "#a *b$ <c>\x0b|&%", "é漢 🙂 é漢 🙂 é漢 🙂", "a a a a", "\x85x\x1cy z"]
)
def test_base_measures(text):
    assert quality.base_measures(text) == brute(text)


def test_base_measures_of_real_texts(spark, small):
    for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect():
        assert quality.base_measures(r["text"]) == brute(r["text"])


def test_fertility():
    with open(PATHS[0], "rb") as a, open(PATHS[1], "rb") as b:
        fertility = quality.Fertility(a.read(), b.read(), PATHS[2])
    model = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    text = "Some ordinary text, 漢字 and ꙮ."
    ids = model.encode(text)
    n, by_bytes, by_pieces, fallback, entropy = fertility.measure(text)
    assert n == len(ids) and by_pieces == len(text) / n
    assert fallback == sum(map(model.is_byte, ids)) / n > 0
    assert 0 < entropy <= 1
    assert fertility.measure("") == (0, 0.0, 0.0, 0.0, 0.0)
    assert fertility.measure("a")[4] == 0.0
    assert "".join(quality.pieces("word " * 90_000)) == "word " * 90_000


def test_junk_is_rejected_and_prose_is_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = quality.quality(docs.join(labels.select("doc_id", "quality"), "doc_id").select("doc_id", "text", "lang"), *PATHS)
    rows = judged.join(labels, "doc_id").where("not base_failed").select("quality", "kept").collect()
    share = {q: sum(r["kept"] for r in rows if r["quality"] == q) / sum(r["quality"] == q for r in rows) for q in (0, 1)}
    assert share[1] > 0.99
    assert share[0] < 0.6


def test_odd_rows(odd, empty):
    rows = quality.quality(odd, *PATHS).collect()
    texts = Counter((r["doc_id"], *brute(r["text"] or "")) for r in odd.collect())
    found = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows)
    assert found == texts
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
        assert r["kept"] is not None
    assert quality.quality(empty, *PATHS).count() == 0


def measured_rows(spark, lang, chars, first):
    rows = [(first + i, lang, first + i, 600, 3000, 0, 0, 0, 600, c, c, 0.0, 0.8) for i, c in enumerate(chars)]
    return spark.createDataFrame(rows, quality.T.StructType([quality.T.StructField("doc_id", quality.T.LongType()), quality.T.StructField("lang", quality.T.StringType()), *quality.FEATURES]))


def test_small_languages_have_bands_of_their_own(spark):
    large = measured_rows(spark, "en", [4.0 + 0.001 * (i % 200) for i in range(1000)], 0)
    kept = {}
    for n in (41, 99, 100, 400):
        # Far from the large language, with one text far from the others.
        texts = [1.5 + 0.01 * (i % 20) for i in range(n - 1)] + [4.0]
        judged = quality.judge(quality.staged(large.unionAll(measured_rows(spark, "zh", texts, 10_000))))
        kept[n] = [r["kept"] for r in judged.where("lang = 'zh'").orderBy("doc_id").collect()]
    assert all(found == [True] * (n - 1) + [False] for n, found in kept.items())
    one = quality.judge(quality.staged(large.unionAll(measured_rows(spark, "ja", [1.5], 20_000))))
    assert one.where("lang = 'ja'").first()["kept"]
