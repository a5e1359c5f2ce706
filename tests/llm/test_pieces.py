"""SentencePiece coding against the library, and Viterbi against all segmentations."""

import random
from collections import Counter

import numpy as np

from lakeaudit.llm import pieces


def test_merge_model_matches_the_library_and_round_trips():
    import sentencepiece

    path = pieces.public_path()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abeéñ中1 2\n\t▁😀ﬁthe   .,'\x01") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["", " ", "   ", "a" * 3000, "<s> <0x41>"]
    for text, ids in zip(texts, pieces.encode_texts(path, texts)):
        numbers = np.frombuffer(ids, "<u4")
        assert numbers.tolist() == library.encode(text)
        assert pieces.decode_ids(path, numbers) == library.decode(numbers.tolist()) == text.replace("▁", " ")


def test_unigram_states_find_the_best_sum():
    rng = random.Random(4)
    names = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(25)} | set("abc")
    scores = {p: -rng.uniform(1, 9) * len(p) ** 0.5 for p in names}
    ids = {p: i for i, p in enumerate(sorted(names))}
    coder = pieces.Coder(scores, ids, lambda p: [99], merges=False)

    def best(word):
        if not word:
            return 0.0
        return max(scores[word[:n]] + best(word[n:]) for n in range(1, len(word) + 1) if word[:n] in scores)

    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    coder.learn(words)
    by_id = sorted(names)
    for w in words:
        parts = [by_id[i] for i in np.frombuffer(coder.known[w], "<u4")]
        assert "".join(parts) == w
        assert abs(sum(scores[p] for p in parts) - best(w)) < 1e-9


def test_tables(docs, no_docs, rows):
    path = pieces.public_path()
    clash = docs.withColumnRenamed("node", "ids")
    back = pieces.decode(pieces.encode(clash, path), path).collect()
    assert Counter(r["decoded"] for r in back) == Counter(r[1] for r in rows)
    assert Counter((r["doc_id"], r["n_words"]) for r in back) == Counter((r[0], r[8]) for r in rows)
    assert pieces.decode(pieces.encode(no_docs, path), path).collect() == []


def test_words_are_cut_before_marks():
    assert pieces.words("▁a▁▁b▁") == ["▁a", "▁▁b", "▁"]
    assert pieces.words("▁a▁b") == ["▁a", "▁b"]
    assert pieces.words("") == [] or pieces.words("") == [""]


def test_words_kept_in_a_worker_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 300)
    rng = random.Random(6)
    word = lambda: pieces.MARK + "".join(rng.choice("abcdef") for _ in range(12))
    coder = pieces.Coder(dict.fromkeys(pieces.MARK + "abcdef", -1.0), {c: i for i, c in enumerate(pieces.MARK + "abcdef")}, lambda p: [99], False)
    often = [word() for _ in range(50)]
    for _ in range(40):
        texts = ["".join(often), "".join(word() for _ in range(100))]
        for text, ids in zip(texts, coder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == [coder.ids[c] for c in text]
        assert len(coder.known) <= 300 and len(coder.older) <= 300
    # words that come again and again are kept
    assert set(often) <= set(coder.known) | set(coder.older)
