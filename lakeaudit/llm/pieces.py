"""SentencePiece encoding and decoding with a Viterbi pass shared between words.

Pieces never cross the mark in front of a word, so a text is encoded word by word. The distinct
marked words of a run of texts are sorted, which is their trie in depth-first order: a word goes on
from the forward states of the prefix it shares with the word before it, and only the rest of it is
new. A state holds the best way to write a prefix and its last piece.

* Unigram models: the state's score is the largest sum of piece scores (classic Viterbi).
* Merge models (such as the public vocabulary): scores are merge ranks, and their sum does not decide.
  A way counts if every two neighbouring pieces, merged from characters by rank, come out as these two;
  one way has that property, the model's own. Whether two pieces may stand together is worked out
  once per pair.

Ids are little-endian unsigned 32-bit integers in a binary column. Nothing is shuffled.

Defined results
  * A null text gives null ids and a null text again; an empty text gives no ids and an empty text.
  * Characters outside the vocabulary become their bytes' pieces.
  * Decoding joins the pieces, reads bytes as UTF-8 (bad ones become U+FFFD), turns marks into spaces
    and drops the one that encoding put in front. Control pieces are left out; an unknown id fails.
  * Rows are taken one by one: repeated rows, null keys and other columns do not matter; ``encode``
    and ``decode`` replace a column of the name they add.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import give_back, ready, table, text_slices

MARK = "▁"
#: Words of a generation kept with their ids in a worker: a full one becomes the older, which only words in use survive.
CACHE_WORDS = 300_000
_CACHED_CHARS = 64
#: Pairs whose answer is kept; emptied when full.
_PAIRS = 500_000
#: Bytes of ids decoded at a time.
RUN_BYTES = 1 << 18
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def words(marked: str) -> list[str]:
    """The text cut before every mark that follows another character."""
    if "\x01" in marked or MARK * 2 in marked:
        return _WORDS.findall(marked)
    parts = marked.replace(MARK, "\x01" + MARK).split("\x01")
    return parts if parts[0] else parts[1:]


class Coder:
    """Encodes marked words; ``scores`` are the pieces of a text, ``ids`` their numbers."""

    def __init__(self, scores: dict[str, float], ids: dict[str, int], unknown, merges: bool):
        self.scores, self.ids, self.unknown, self.merges = scores, ids, unknown, merges
        self.longest = max(map(len, scores), default=1)
        self.lowest = min(scores.values(), default=0.0) - 10.0
        #: what pieces end in, with the score of those that are pieces themselves
        self.tails: dict[str, float | None] = dict.fromkeys(p[i:] for p in scores for i in range(1, len(p))) | scores
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def side_by_side(self, left: str, right: str) -> bool:
        """Whether merging the best-ranked neighbours of both texts' characters, the leftmost first, ends in these two."""
        get, none = self.scores.get, -float("inf")
        parts, edge = [*left, *right], len(left)
        ranks = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = max(ranks)
            if best == none:
                break
            at = ranks.index(best)
            if at + 1 == edge:  # a merge across the border
                return False
            if at < edge:
                edge -= 1
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at], none)
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1], none)
        return len(parts) == (2 if left else 1)

    def together(self, left: str, right: str) -> bool:
        pair = (left, right)
        held = self.pairs.get(pair)
        if held is None:
            if len(self.pairs) >= _PAIRS:
                self.pairs.clear()
            held = self.pairs[pair] = self.side_by_side(left, right)
        return held

    def _state(self, word: str, end: int, states: list[tuple[float, str]]) -> tuple[float, str]:
        """The best way to write ``word[:end]``, from the states of its prefixes."""
        best: tuple[float, str] | None = None
        tails, pairs = self.tails, self.pairs
        for start in range(end - 1, max(end - self.longest, 0) - 1, -1):
            piece = word[start:end]
            score = tails.get(piece, 0)
            if score is None or score == 0 and piece not in tails:
                if end - start > 1:
                    if score is None:
                        continue
                    break  # no piece ends so, and none that is longer
                score = self.lowest
            before, last = states[start]
            if self.merges:  # one way at most is the model's own, so the first found is it
                fits = pairs.get((last, piece))
                if fits or fits is None and self.together(last, piece):
                    return before + score, piece
            elif best is None or before + score >= best[0]:
                best = (before + score, piece)
        if best is None:
            raise ValueError(f"no way to write {word[:end]!r}")
        return best

    def learn(self, missing: list[str]) -> None:
        """Encodes words in sorted order, each from the states of the prefix shared with the last."""
        states: list[tuple[float, str]] = [(0.0, "")]
        previous = ""
        for word in sorted(missing):
            shared, most = 0, min(len(word), len(previous))
            while shared < most and word[shared] == previous[shared]:
                shared += 1
            del states[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                states.append(self._state(word, end, states))
            out, end = [], len(word)
            while end:
                piece = states[end][1]
                out.append(piece)
                end -= len(piece)
            numbers = array("I")
            for piece in reversed(out):
                number = self.ids.get(piece)
                numbers.extend([number] if number is not None else self.unknown(piece))
            self.known[word] = numbers.tobytes()
            previous = word

    def encode(self, marked: list[str]) -> list[bytes]:
        known = self.known
        cut = [words(t) for t in marked]
        found = [list(map(known.get, parts)) for parts in cut]
        gaps = [i for i, ids in enumerate(found) if None in ids]
        missing = {w for i in gaps for w, ids in zip(cut[i], found[i]) if ids is None}
        if missing:
            if len(known) + len(missing) > CACHE_WORDS:
                self.older, self.known = known, {}
                known = self.known
            again = {w: self.older[w] for w in missing if w in self.older}
            known.update(again)
            new = [w for w in missing if w not in again]
            self.learn(new)
            for i in gaps:
                found[i] = [known[w] if ids is None else ids for w, ids in zip(cut[i], found[i])]
            for w in new:
                if len(w) > _CACHED_CHARS:
                    del known[w]
        return [b"".join(ids) for ids in found]


@lru_cache(maxsize=2)
def _model(path: str):
    """(library's processor for normalising, coder, bytes of every piece)."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    scores, ids, surface, of_byte = {}, {}, [], {}
    for i, p in enumerate(model.pieces):
        if p.type == kinds.BYTE:
            byte = int(p.piece[3:5], 16)
            of_byte[byte] = i
            surface.append(bytes([byte]))
        elif p.type in (kinds.NORMAL, kinds.USER_DEFINED):
            scores[p.piece], ids[p.piece] = p.score, i
            surface.append(p.piece.replace(MARK, " ").encode("utf-8"))
        else:
            surface.append(b"" if p.type != kinds.UNKNOWN else model.trainer_spec.unk_surface.encode("utf-8"))
    if any(MARK in p.lstrip(MARK) for p in scores):
        raise ValueError("this vocabulary has pieces across words")
    types = model.trainer_spec
    if types.model_type not in (types.UNIGRAM, types.BPE):
        raise ValueError("only unigram and merge models are encoded here")

    def unknown(piece: str) -> list[int]:
        if not types.byte_fallback:
            return [types.unk_id]
        return [of_byte[b] for b in piece.encode("utf-8")]

    return processor, Coder(scores, ids, unknown, types.model_type == types.BPE), surface


def encode_texts(path: str, texts: list[str]) -> list[bytes]:
    processor, coder, _ = _model(path)
    return coder.encode([processor.Normalize(t) if t else "" for t in texts])


def decode_ids(path: str, ids: np.ndarray) -> str:
    _, _, surface = _model(path)
    text = b"".join([surface[i] for i in ids.tolist()]).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, path: str, text_col: str = "text", name: str = "ids") -> DataFrame:
    """The rows with the ids of the text as a further column."""
    ready(docs.sparkSession)
    columns = [c for c in docs.columns if c != name]
    place = columns.index(text_col)

    def run(batches):
        for batch in batches:
            for start, stop, _, _ in text_slices(batch.column(place)):
                part = batch.slice(start, stop - start)
                texts = part.column(place)
                ids = encode_texts(path, texts.fill_null("").to_pylist())
                known = texts.is_valid().to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([b if k else None for b, k in zip(ids, known)], pa.binary())],
                    names=[f"c{i}" for i in range(len(columns) + 1)])
            give_back()

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([f"c{i} {kinds[c]}" for i, c in enumerate(columns)] + [f"c{len(columns)} binary"])
    numbered = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    return numbered.mapInArrow(run, schema).toDF(*columns, name)


def _runs(ids: pa.Array) -> list[tuple[int, int]]:
    """(start, stop) of runs of rows of ``RUN_BYTES`` of ids."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(ids), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(sizes // RUN_BYTES)) + 1
    ends = [*cuts.tolist(), len(ids)] if len(ids) else []
    return list(zip([0, *ends], ends))


def decode(rows: DataFrame, path: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with the text of the ids as a further column."""
    ready(rows.sparkSession)

    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        parts = [pa.array([None if b is None else decode_ids(path, np.frombuffer(b, "<u4")) for b in ids[start:stop].to_pylist()],
                          pa.string()) for start, stop in _runs(ids)]
        give_back()
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return rows.withColumn(name, run(ids_col))


def public_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6(spark, sf_dir: str) -> DataFrame:
    path = public_path()
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
    back = decode(coded, path)
    return back.select(
        "doc_id", F.coalesce(F.octet_length("ids") / 4, F.lit(0)).cast("long").alias("n_pieces"),
        F.coalesce(F.crc32("ids"), F.lit(0)).cast("long").alias("ids_crc32"),
        F.sha2(F.coalesce("decoded", F.lit("")).cast("binary"), 256).alias("decoded_sha256"))
