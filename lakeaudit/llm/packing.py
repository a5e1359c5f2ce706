"""Best-fit packing of documents into sequences by bin completion.

``pieces`` encodes whole texts and cuts only those longer than a sequence; ``pack`` gives every piece
a sequence and an offset. Pieces are counted per length, so the packing problem is a histogram with
at most ``capacity`` entries, whatever the number of documents; it is solved by branch-and-bound:

* the largest remaining length is completed by fillings of the rest of its sequence, of any number of
  pieces, fewest wasted tokens first; a completion is repeated as often as the counts allow, and then
  less often. Fillings are made as they are asked for; sums that the counts cannot make are never tried;
* a branch is pruned once its waste exceeds what an improvement may waste, or if its rest was met before;
* branches that pass over the fewest better-looking choices come first;
* the incumbent starts as best-fit decreasing and is replaced by every better solution. The search
  ends at the lower bound, with nothing left to try, or after ``node_limit`` nodes; the best solution
  found then stands.

The plan (completion, repetitions) is a table of at most a few thousand rows, as it depends on the
number of lengths only. Pieces of one length are numbered without gaps in a distributed way, and a
piece finds its place from its length and number by binary search in the plan.

Defined results
  * A null text is empty; an empty document is the end token alone. Repeated rows are packed each.
  * ``pieces`` returns the key column, ``piece, start, length, ids`` and nothing else, so other
    columns cannot clash. A null key stays null. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import json
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions.durable import shared_folder
from lakeaudit.llm.common import durable, gapless, ready, table, text_slices

CAPACITY = 1024
END_ID = 2
#: Fixed value: how byte-level vocabularies split a text before they merge.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes: printable bytes stand for themselves,
    the others for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=1)
def _coder(path: str):
    """A function from a text to its ids.

    Where the file is a plain byte-level vocabulary whose ids follow the order of its merges, ids are
    ranks, and the rank coder of the same vocabulary gives the same ids in half the time and without
    a cache of words. Any other file is read by the library it was made for.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    model, split = parts["model"], parts.get("pre_tokenizer") or {}
    vocabulary, merges = model.get("vocab", {}), model.get("merges", [])
    plain = model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True) \
        and not split.get("add_prefix_space", True) and not parts.get("normalizer") and not model.get("ignore_merges") \
        and all(vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) == 256 + i for i, m in enumerate(merges)) \
        and len(vocabulary) == 256 + len(merges)
    if plain:
        import tiktoken

        letter_bytes = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(letter_bytes[c] for c in token): i for token, i in vocabulary.items()}
        return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return lambda text: library.encode(text, add_special_tokens=False).ids


def encoded(path: str, texts: Iterable[str]) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers."""
    coder = _coder(path)
    return [np.array(coder(text), dtype="<u4").tobytes() for text in texts]


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: whole sequences, and before them what is left over."""
    if total <= capacity:
        return [total]
    first = total % capacity
    return ([first] if first else []) + [capacity] * (total // capacity)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids): the token ids of every document, cut to the capacity."""
    ready(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches):
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for start, stop, _, _ in text_slices(texts):
                rows = texts.slice(start, stop - start).fill_null("").to_pylist()
                owner, number, begin, ids = [], [], [], []
                for i, blob in enumerate(encoded(tokenizer_path, rows)):
                    blob += end
                    at = 0
                    for k, n in enumerate(cut_lengths(len(blob) // 4, capacity)):
                        owner.append(start + i)
                        number.append(k)
                        begin.append(at)
                        ids.append(blob[4 * at:4 * (at + n)])
                        at += n
                yield pa.record_batch({
                    id_col: keys.take(pa.array(owner, pa.int64())), "piece": pa.array(number, pa.int32()),
                    "start": pa.array(begin, pa.int64()),
                    "length": pa.array([len(b) // 4 for b in ids], pa.int64()), "ids": pa.array(ids, pa.binary())})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        encode, f"`{id_col}` {kind}, piece int, start long, length long, ids binary")


# ---------------------------------------------------------------- bin completion on the histogram

Plan = list[tuple[tuple[int, ...], int]]


def best_fit(counts: np.ndarray, capacity: int) -> Plan:
    """Best-fit decreasing; bins with equal contents are one entry with a count."""
    rooms: dict[int, dict[tuple[int, ...], int]] = {capacity: {}}
    for size in range(capacity, 0, -1):
        left = int(counts[size])
        while left:
            room = next((r for r in range(size, capacity) if rooms.get(r)), None)
            if room is None:
                per_bin = min(capacity // size, left)
                bins = left // per_bin
                content = (size,) * per_bin
                rooms.setdefault(capacity - size * per_bin, {})
                target = rooms[capacity - size * per_bin]
                target[content] = target.get(content, 0) + bins
                left -= bins * per_bin
                continue
            content, bins = next(iter(rooms[room].items()))
            take = min(bins, left)
            if bins == take:
                del rooms[room][content]
            else:
                rooms[room][content] = bins - take
            target = rooms.setdefault(room - size, {})
            target[(*content, size)] = target.get((*content, size), 0) + take
            left -= take
    return [(content, n) for entries in rooms.values() for content, n in entries.items()]


def _reachable(counts: np.ndarray, room: int) -> tuple[list[int], list[int]]:
    """The sizes up to ``room``, ascending, and for every prefix of them the sums it can make, as bits."""
    sizes = [int(s) for s in np.flatnonzero(counts[:room + 1]) if s]
    whole, sums = (1 << (room + 1)) - 1, [1]
    for s in sizes:
        known, left, step = sums[-1], min(int(counts[s]), room // s), 1
        while left:
            step = min(step, left)
            known |= (known << (s * step)) & whole
            left, step = left - step, 2 * step
        sums.append(known)
    return sizes, sums


def fillings(counts: np.ndarray, room: int) -> Iterator[tuple[int, ...]]:
    """All fillings of ``room`` that the counts allow, of any number of items, least waste first and
    then by descending lengths; made one by one as they are asked for.

    An item as large as the room dominates every other filling and is the only one then.
    """
    sizes, sums = _reachable(counts, room)
    if sizes and sizes[-1] == room:
        yield (room,)
        return

    def exact(total: int, upto: int, begun: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        if not total:
            yield begun
            return
        for i in range(min(upto, bisect_right(sizes, total)) - 1, -1, -1):
            if not sums[i + 1] >> total & 1:
                return  # nor do shorter prefixes make it
            s = sizes[i]
            for n in range(min(int(counts[s]), total // s), 0, -1):
                if sums[i] >> (total - n * s) & 1:
                    yield from exact(total - n * s, i, (*begun, *(s,) * n))

    for total in range(room, -1, -1):
        if sums[-1] >> total & 1:
            yield from exact(total, len(sizes), ())


def _repetitions(most: int) -> Iterator[int]:
    """Every number from ``most`` to 1: the most, one less, halves, then the others downwards."""
    first = list(dict.fromkeys([most, *[most - 1] * (most > 1), *(most >> k for k in range(1, most.bit_length()))]))
    yield from first
    known = set(first)
    yield from (n for n in range(most - 1, 0, -1) if n not in known)


def _choices(left: np.ndarray, capacity: int, spare: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Every (contents with the largest length, repetitions) that wastes at most ``spare``, by turns: the
    next filling, and the next smaller repetition of each one before it."""
    top = int(np.flatnonzero(left)[-1])
    after = left.copy()
    after[top] -= 1
    source, begun = fillings(after, capacity - top), []
    while source is not None or begun:
        new = next(source, None) if source is not None else None
        waste = capacity - top - sum(new or ())
        if new is None or waste > spare:
            source = None  # what follows wastes no less
        else:
            content = (top, *new)
            most = min(int(left[s]) // content.count(s) for s in set(content))
            most = min(most, spare // waste) if waste else most
            begun.append((content, _repetitions(most)))
        for entry in reversed(begun[:]):
            times = next(entry[1], None)
            if times is None:
                begun.remove(entry)
            else:
                yield entry[0], times


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any solution needs: the best of total over fullest bin, and lengths over half with
    what does not fit beside them."""
    counts = np.asarray(counts, dtype=np.int64)
    tokens = counts * np.arange(capacity + 1)
    total = int(tokens.sum())
    if not total:
        return 0
    fullest = _reachable(counts, capacity)[1][-1].bit_length() - 1
    many, much = np.cumsum(counts), np.cumsum(tokens)
    least = np.arange(capacity // 2 + 1)  # lengths under ``least`` are left out
    half = capacity // 2
    alone = many[capacity] - many[capacity - least]
    large, large_tokens = many[capacity - least] - many[half], much[capacity - least] - much[half]
    small_tokens = much[half] - np.where(least > 0, much[least - 1], 0)
    over = np.maximum(0, small_tokens - (large * capacity - large_tokens))
    return max(-(-total // fullest), int((alone + large + -(-over // capacity)).max()))


def bin_completion(counts: np.ndarray, capacity: int, node_limit: int = 6000) -> Plan:
    """(contents, repetitions) with as few bins as the search finds; ``counts[s]`` items of size s."""
    counts = np.asarray(counts, dtype=np.int64)
    total = int((counts * np.arange(capacity + 1)).sum())
    best = best_fit(counts, capacity)
    bins = sum(n for _, n in best)
    bound = lower_bound(counts, capacity)
    if bins <= bound:
        return best
    nodes, made, seen = 0, 0, {}
    # (choices passed over, -sequences filled, running number, node): the fewest passed over go first
    queue: list[tuple] = [(0, 0, 0, (counts, total, None, _choices(counts, capacity, (bins - 1) * capacity - total)))]
    while queue and bins > bound and nodes < node_limit:
        passed, used, _, (left, rest, path, choices) = heappop(queue)
        used = -used
        spare = (bins - 1 - used) * capacity - rest  # what an improvement may still waste
        choice = next(choices, None) if spare >= 0 else None
        if choice is None:
            continue
        nodes += 1
        made += 1
        heappush(queue, (passed + 1, -used, made, (left, rest, path, choices)))
        content, times = choice
        spare -= times * (capacity - sum(content))
        if spare < 0:
            continue
        state = left.copy()
        for s in set(content):
            state[s] -= content.count(s) * times
        done, way = used + times, (path, content, times)
        rest -= times * sum(content)
        if not rest:
            best, bins = [], done
            while way:
                way, content, times = way
                best.append((content, times))
            continue
        key = blake2b(state.tobytes(), digest_size=16).digest()
        if seen.get(key, bins) > done:
            seen[key] = done
            made += 1
            heappush(queue, (passed, -done, made, (state, rest, way, _choices(state, capacity, spare))))
    return best


def plan_rows(plan: Plan) -> dict[str, np.ndarray]:
    """The plan per (length, first number): which sequences, how many of the length in each, where."""
    rows, used, base = [], {}, 0
    for content, times in plan:
        offset = 0
        for size in sorted(set(content), reverse=True):
            per = content.count(size)
            rows.append((size, used.get(size, 0), base, per, offset))
            used[size] = used.get(size, 0) + per * times
            offset += per * size
        base += times
    rows.sort()
    names = ("length", "first", "base", "per", "offset")
    columns = zip(*rows) if rows else ([],) * 5
    return {n: np.array(c, dtype=np.int64) for n, c in zip(names, columns)}


_NUMBER_BITS = 48


def pack(pieces_df: DataFrame, capacity: int = CAPACITY, node_limit: int = 6000) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to the capacity."""
    pieces_df = durable(pieces_df)
    sizes = pieces_df.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in sizes:
        if not 1 <= row["length"] <= capacity:
            raise ValueError(f"a piece has {row['length']} tokens; the capacity is {capacity}")
        counts[row["length"]] = row["count"]
    plan = plan_rows(bin_completion(counts, capacity, node_limit))
    parts = max(64, int(counts.max() // 500_000) + 1) if sizes else 1
    order = [c for c, kind in pieces_df.dtypes if not kind.startswith(("map", "variant"))]
    numbered = gapless(pieces_df, "length", order, "_number", parts)
    starts = (plan["length"] << _NUMBER_BITS) + plan["first"]

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("_number").to_numpy()
            at = np.searchsorted(starts, (length << _NUMBER_BITS) + number, "right") - 1
            within, per = number - plan["first"][at], plan["per"][at]
            kept = batch.drop_columns(["_number"])
            yield kept.append_column("sequence_id", pa.array(plan["base"][at] + within // per)).append_column(
                "offset", pa.array(plan["offset"][at] + (within % per) * length))

    fields = [f"`{c}` {kind}" for c, kind in pieces_df.dtypes]
    return numbered.mapInArrow(place, ", ".join([*fields, "sequence_id long", "offset long"]))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of every sequence, from packed pieces that still carry ids.

    A group holds at most one capacity of tokens.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda all_ids, x: F.concat(all_ids, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def public_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def packed_documents(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): every document's pieces with their tokens.

    The pieces are written once; numbers and places are found on their short columns alone, and the
    tokens meet their place again by the number of the piece.
    """
    spark = ready(docs.sparkSession)
    folder = f"{shared_folder(spark)}/pieces-{uuid.uuid4().hex[:12]}"
    cut = pieces(docs, tokenizer_path or public_path())
    cut.withColumn("_piece_no", F.monotonically_increasing_id()).write.parquet(folder)
    stored = spark.read.parquet(folder)
    placed = pack(stored.select("length", "_piece_no")).drop("length")
    return stored.join(placed, "_piece_no").drop("_piece_no")


def op8(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cut = pieces(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), public_path())
    return pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
