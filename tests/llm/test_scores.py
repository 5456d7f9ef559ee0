"""Quality, toxicity, language and token counts: held-out accuracy, exact counts, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from llm_texts import sentence

from tidemill.llm import language, quality_trees, ragged, token_counts, toxicity

LABELS = "doc_id long, quality int, toxic int"


def fold(n: int, folds: int) -> int:
    return zlib.crc32(str(n).encode()) % folds


@pytest.fixture(scope="module")
def labelled(spark, frame):
    source = random.Random(3)
    rows, labels = [], []
    for n in range(1200):
        bad, toxic = n % 5 == 0, n % 7 == 0
        words = sentence(source, source.randint(15, 60)).split()
        if toxic:
            words[source.randrange(len(words))] = source.choice(["grunzel", "grunzels", "vorfex"])
        text = " ".join(w.upper() + "!!" if bad else w for w in words)
        rows.append((n, text))
        labels.append((n, int(not bad), int(toxic)))
    return frame(rows), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize("column", ["quality", "toxic"])
def test_held_out_documents_are_classified(labelled, column):
    documents, labels = labelled
    score = quality_trees.score_quality if column == "quality" else toxicity.score_toxicity
    folds, out = (4, 2) if column == "quality" else (3, 1)
    truth = {r.doc_id: r[column] for r in labels.collect()}
    found = score(documents, labels).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (fold(r.doc_id, folds) == out) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    right = [r.predicted == truth[r.doc_id] for r in found if r.held_out]
    assert np.mean(right) > 0.95


@pytest.mark.parametrize("score", [quality_trees.score_quality, toxicity.score_toxicity])
def test_scores_of_odd_rows_and_tables(spark, frame, odd_rows, score):
    documents, none = frame(odd_rows), spark.createDataFrame([], LABELS)
    assert {r.score for r in score(documents, none).collect()} == {0.5}
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (None, 1, 1), (7, None, None), (5, 1, 1), (6, 0, 0), (99, 1, 0)], LABELS)
    found = score(documents, labels).collect()
    assert len(found) == len(odd_rows) and all(0 <= r.score <= 1 for r in found)
    same = [r.score for r in found if r.text == "same words in this row"]
    assert len(same) == 2 and same[0] == same[1]
    assert score(frame([]), labels).count() == 0


def test_trees_walk_as_one_by_one():
    source = np.random.default_rng(5)
    x = source.normal(size=(400, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = quality_trees.grow(x, y, trees=20)
    inner = trees.feature.shape[1]

    def walk(row):
        total = trees.start
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value, strict=True):
            at = 0
            while at < inner:
                at = 2 * at + 1 + int(row[feature[at]] > threshold[at])
            total += value[at - inner]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x), [walk(row) for row in x])
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95


def test_label_model_discounts_copies_of_a_voter():
    source = np.random.default_rng(1)
    truth = (source.random(3000) < 0.3).astype(int)
    vote = np.where(source.random(3000) < 0.8, truth, 1 - truth)
    other = np.where(source.random(3000) < 0.8, truth, 1 - truth)
    anchor = np.where(truth > 0, 1, -1)
    votes = np.stack([vote, vote, vote, other, anchor], 1)
    model = toxicity.fit_label_model(votes, truth)
    assert model.block[0] == model.block[1] == model.block[2] != model.block[3]
    assert abs(model.given[1, 3, 2] - 0.8) < 0.05
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.99


def test_language_of_held_out_documents(frame):
    source = random.Random(9)
    kinds = {"aa": "abrekado", "bb": "xyzwquvo"}
    rows = []
    for n in range(400):
        lang = source.choice(["aa", "bb"])
        text = " ".join("".join(source.choice(kinds[lang]) for _ in range(6)) for _ in range(12))
        rows.append((n, text, lang, "s", 0))
    found = language.predict_language(frame(rows)).collect()
    truth = {r[0]: r[2] for r in rows}
    assert all(r.lang_pred == truth[r.doc_id] for r in found if r.held_out)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_rows(frame, odd_rows):
    found = language.predict_language(frame(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    by_text = {r.text: r.lang_pred for r in found}
    assert by_text[None] == by_text[""] == by_text[" \t\n "] == "und"
    assert {r.lang_pred for r in found} <= {"und", "en", "de", "xx"}
    assert all(r.score == 0 for r in found if r.lang_pred == "und")
    unlabelled = language.predict_language(frame([(1, "some text")])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]
    assert language.predict_language(frame([])).count() == 0


def plain_code_length(counts, data):
    """Frozen statistics by hand: each byte costs its share in the longest context met, or escapes."""

    def share(context, byte):
        seen = counts.get(context)
        if seen is None:
            return share(context[1:], byte)
        whole = sum(seen.values()) + len(seen)
        if byte in seen:
            return seen[byte] / whole
        return len(seen) / whole * (1 / 256 if not context else share(context[1:], byte))

    return -sum(np.log2(share(data[max(0, i - 3) : i], data[i])) for i in range(len(data)))


def plain_counts(texts):
    counts = {}
    for text in texts:
        data = text.lower().encode()
        for i in range(len(data)):
            for k in range(min(i, 3) + 1):
                after = counts.setdefault(data[i - k : i], {})
                after[data[i]] = after.get(data[i], 0) + 1
    return counts


def test_code_lengths_are_those_of_the_counts(spark, frame):
    rows = [(n, "abcabd abc", "aa", "s", 0) for n in range(8) if fold(n, 4) != 2]
    model = language.train(frame(rows))
    expected = plain_code_length(plain_counts(r[1] for r in rows), b"abdz cab")
    data = np.frombuffer(b"abdz cab", np.uint8)
    assert abs(model.code_lengths(data, np.array([0, len(data)]))[0, 0] - expected) < 1e-9


@pytest.fixture(scope="module")
def beside_a_hot_language():
    """A language of many texts with many thousand contexts, and one of few texts whose own are all rare."""
    source = random.Random(31)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(n, "".join(source.choice(letters) for _ in range(400)), "hot", "s", 0) for n in range(150)]
    rows += [(1000 + n, "".join(source.choice("\u0436\u0434\u043b\u0444\u044d\u0431\u044e") for _ in range(30)), "rare", "s", 0) for n in range(6)]
    return rows + [(2000, None, "hot", "s", 0), (2001, rows[0][1], None, "s", 0), (2002, "", "rare", "s", 0)]


def test_no_context_is_lost_beside_a_hot_language(frame, beside_a_hot_language):
    model = language.train(frame(beside_a_hot_language))
    texts = {lang: [r[1] for r in beside_a_hot_language if r[1] and r[2] == lang and fold(r[0], 4) != 2] for lang in ("hot", "rare")}
    counts = {lang: plain_counts(texts[lang]) for lang in texts}
    assert sum(len(context) == 3 for context in counts["hot"]) > 4096 and model.languages == ["hot", "rare"]
    tried = [r[1].encode() for r in beside_a_hot_language[:3] + beside_a_hot_language[150:156]]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in tried])))
    found = model.code_lengths(np.frombuffer(b"".join(tried), np.uint8), offsets)
    expected = [[plain_code_length(counts[lang], data) for lang in ("hot", "rare")] for data in tried]
    assert np.allclose(found, expected, rtol=1e-9)


def test_a_tree_in_parts_gives_the_same(frame, beside_a_hot_language):
    rows = frame(beside_a_hot_language).selectExpr("*", "'x' AS _found", "1 AS lengths", "2 AS row")
    one, many = (
        {(r.doc_id, r.text): (r.lang_pred, r.held_out, round(r.score, 9), r["_found"], r.lengths) for r in found.collect()}
        for found in (language.predict_language(rows), language.predict_language(rows, part_entries=40_000))
    )
    assert one == many and len(one) == len(beside_a_hot_language)
    assert language.trained(rows, part_entries=40_000)[1] > 2


@pytest.fixture(scope="module")
def vocabulary():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_50k.json")


def test_counts_equal_the_library(spark, frame, odd_rows, vocabulary):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(vocabulary)
    source = random.Random(11)
    letters = ["a", "b", " ", "  ", "\n", "'s", "'", "1", "é", "漢", "　", "\x1c", "\x85", "!", "<|endoftext|>", "ß", "𝔘", "́", "the", "ing"]
    texts = ["".join(source.choice(letters) for _ in range(source.randint(0, 60))) for _ in range(400)]
    texts += ["aaaaaaa" * 50, "<|endoftext|>", "<|endoftext|><|endoftext|> x", *[r[1] for r in odd_rows]]
    counted = token_counts.count_tokens(frame([(n, t) for n, t in enumerate(texts)]), vocabulary).collect()
    expected = [len(e.ids) for e in reference.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    found = {r.doc_id: r for r in counted}
    assert [found[n].n_tokens for n in range(len(texts))] == expected
    assert all(r.n_bytes == len((r.text or "").encode()) and r.over_limit == (r.n_tokens > 512) for r in counted)
    assert token_counts.count_tokens(frame([]), vocabulary).count() == 0


def test_known_pretokens_are_forgotten_without_effect(vocabulary):
    merges = token_counts.Merges.read(vocabulary)
    texts = ["one two three", "four five six one", "seven two"] * 3
    small = token_counts.Counter(merges, known=4)
    assert [small.count([t])[0] for t in texts] == token_counts.Counter(merges).count(texts)


def test_slices_keep_documents_apart():
    import pyarrow as pa

    texts = ["one two", None, "", "three", "four  five\tsix", "x" * 50]
    batch = pa.record_batch([pa.array(texts).slice(1), pa.array(range(5))], ["text", "n"])
    words, rows = [], []
    for part, data, offsets in ragged.slices(batch, "text", size=8):
        found = ragged.Words(data, offsets)
        words += [bytes(data[a:b]).decode() for a, b in zip(found.starts, found.ends, strict=True)]
        rows += part.column("n").to_pylist()
    assert rows == list(range(5)) and words == ["three", "four", "five", "six", "x" * 50]
