"""Personal data: fixed patterns, and a bidirectional LSTM-CRF that adds what they miss.

``find`` returns the spans of every whole text. Base spans come from four patterns. The tagger reads
overlapping windows around every decimal digit of any script, at-sign of any width and word ``at``,
wherever it stands in the text (what ``_passes`` lets through holds one of them, so other stretches
cannot hold a span). It reads such digits and wide signs as their ASCII forms; windows are decoded one by one,
pieces of a span that a window cut are joined, and all proposals of a text are reconciled at once:
the non-overlapping set with the largest total certainty (weighted interval scheduling), beside the
base spans. A proposal counts only if it passes the check of its kind (digits, Luhn sum, parts). Emails
may have ``(at)``, ``[at]`` or white space around the at-sign and ``(dot)`` for a dot; a bare word ``at``
counts only with a bare or bracketed ``dot``, as ``at mail.com`` is also plain prose.

``train`` learns from labelled spans: windows of a bounded sample of documents with their base
spans, and the same kinds of data written in other ways, planted into windows without any.

Defined results
  * Offsets are code points, ends exclusive. A null or empty text has no spans.
  * Base spans stay whatever the tagger says; proposals that overlap one are dropped.
  * ``redact`` replaces each span (of overlapping ones, the union) with ``[KIND]`` and keeps all
    other columns; texts without spans stay as they are, null stays null.
  * Rows are judged one by one, so repeated rows, null keys and other columns do not matter. With an
    empty table the tagger learns from planted spans alone.
"""

from __future__ import annotations

import random
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import ready, table, text_slices
from lakeaudit.llm.tagger import OTHER, OTHER_LETTER, PAD, Tagger

KINDS = ("email", "ip", "card", "phone")
#: Documents in the sample that the tagger learns from, windows planted, batches of training.
SAMPLE_DOCS = 1_500
PLANTED = 1_400
STEPS = 700
WINDOW, STRIDE, MARGIN = 80, 32, 24

# The patterns are fixed by the contract of the query.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match begins where its digits begin, so the rest of a long run need not be tried
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_TRIGGER = re.compile(r"[\d@\uff20\ufe6b]|(?<![^\W_])[A\uff21a\uff41][T\uff34t\uff54](?![^\W_])")
_BRACKETED = r"\s*[(\[{{<]\s*{}\s*[)\]}}>]\s*"
_BARE = r"\s+{}\s+"
_AT = re.compile(_BRACKETED.format("at") + r"|\s*@\s*", re.IGNORECASE)
_BARE_AT = re.compile(_BARE.format("at"), re.IGNORECASE)
_DOT = re.compile(_BRACKETED.format("dot") + "|" + _BARE.format("dot"), re.IGNORECASE)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0

_NAME, _LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]{1,63}"
#: An email with its at-sign and dots in any form; proposals that touch one are also proposed as it whole.
_FORM = re.compile(
    rf"(?<!{_NAME}){_NAME}{{1,64}}(?:(?:{_AT.pattern}){_LABEL}(?:(?:\.|{_DOT.pattern}){_LABEL})+"
    rf"|{_BARE.format('at')}{_LABEL}(?:(?:{_DOT.pattern}){_LABEL})+)", re.IGNORECASE)


@lru_cache(4096)
def _folded(char: str) -> str:
    """A decimal digit of any script, or another form of an ASCII character, as that character."""
    if char.isdecimal():
        return str(unicodedata.decimal(char))
    plain = unicodedata.normalize("NFKC", char)
    return plain if len(plain) == 1 and plain.isascii() and not plain.isdigit() else char


def fold(text: str) -> str:
    """The text with such characters as ASCII, of the same length."""
    return text if text.isascii() else "".join(map(_folded, text))


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in text.split(".")]
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _is_card(text: str) -> bool:
    d = _digits(text)
    return 14 <= len(d) <= 19 and luhn(d)


def _emails(text: str) -> list[Span]:
    """Leftmost matches, found from the at-signs so that long runs of letters cost nothing."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    spans = _emails(text)
    for kind, pattern, holds in (
            ("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, lambda s: 10 <= len(_digits(s)) <= 15)):
        spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if holds(m[0])]
    return in_order(spans)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# ---------------------------------------------------------------- windows and tags

_TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind


def _forbidden() -> np.ndarray:
    out = np.zeros((_TAGS, _TAGS), np.float32)
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        for before in range(_TAGS):
            if before not in (inside, inside - 1):
                out[before, inside] = -1e4
    return out


def characters(text: str) -> np.ndarray:
    text = fold(text)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ids = np.where(codes < 128, codes, OTHER).astype(np.int16)
    for i in np.flatnonzero(codes >= 128):
        if text[i].isalpha():
            ids[i] = OTHER_LETTER
    return ids


def window_places(text: str) -> list[int]:
    """Starts of windows so that every digit, at-sign and word ``at`` has context on both sides, in steps
    of ``STRIDE`` over stretches of them."""
    places: list[int] = []
    reach = -1
    for m in _TRIGGER.finditer(text):
        if m.start() + MARGIN > reach:
            start = max(0, m.start() - MARGIN)
            if places and start < places[-1] + STRIDE:
                start = places[-1] + STRIDE
            places.append(start)
            reach = start + WINDOW
    both = set(places)
    for p in places:  # a second view of each stretch, half a stride on, so that no span lies on every edge
        both.add(max(0, p - STRIDE))
        both.add(p + STRIDE)
    return sorted(p for p in both if p < len(text))


def _window(ids: np.ndarray, start: int) -> np.ndarray:
    out = np.full(WINDOW, PAD, np.int16)
    part = ids[start:start + WINDOW]
    out[:len(part)] = part
    return out


def _gold(spans: list[Span], start: int) -> np.ndarray:
    tags = np.zeros(WINDOW, np.int8)
    for kind, a, b in spans:
        begin = 1 + 2 * KINDS.index(kind)
        lo, hi = max(a, start) - start, min(b, start + WINDOW) - start
        if lo < hi:
            tags[lo:hi] = begin + 1
            tags[lo] = begin
    return tags


# ---------------------------------------------------------------- decoding

def _proposals(tags: np.ndarray, sure: np.ndarray, start: int, length: int) -> list[tuple[str, int, int, float]]:
    found, at = [], 0
    while at < WINDOW:
        tag = int(tags[at])
        if not tag:
            at += 1
            continue
        end, kind = at + 1, (tag - 1) // 2
        while end < WINDOW and tags[end] == 2 + 2 * kind:
            end += 1
        if start + at < length:
            found.append((KINDS[kind], start + at, min(start + end, length), float(sure[at:end].sum())))
        at = end
    return found


def _plain_email(text: str) -> str:
    """The email with its at-sign and dots as signs."""
    dotted = _DOT.sub(".", text)
    if "@" in text or _AT.search(text) or dotted == text:
        return _AT.sub("@", dotted, count=1)
    return _BARE_AT.sub("@", dotted, count=1)


def _passes(kind: str, text: str) -> bool:
    text = fold(text)
    d = _digits(text)
    if kind == "email":
        text = _plain_email(text.strip())
        local, _, domain = text.partition("@")
        return bool(local.strip()) and "." in domain.strip(". ") and not any(c.isspace() for c in text.strip())
    if kind == "ip":
        parts = re.split(r"[^0-9]+", text.strip("[](). "))
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if any(c.isalpha() for c in text):
        return False
    if kind == "card":
        return 14 <= len(d) <= 19 and luhn(d)
    return 10 <= len(d) <= 15 and len(d) < len(text)  # a bare number may be anything


def reconcile(text: str, proposals: list[tuple[str, int, int, float]], base: list[Span]) -> list[Span]:
    """The non-overlapping set of checked proposals with the largest total certainty.

    Pieces of one kind that overlap are also proposed as their union, which makes whole again what a
    window's edge cut; emails also as the whole written form that they touch.
    """
    emails = [p for p in proposals if p[0] == "email"]
    if emails:
        forms = [m.span() for m in _FORM.finditer(fold(text))]
        proposals = proposals + [("email", c, d, w) for _, a, b, w in emails for c, d in forms
                                 if a < d and c < b and (a, b) != (c, d)]
    weights: dict[Span, float] = {}
    for kind in KINDS:
        own = sorted(p for p in proposals if p[0] == kind)
        run: list[tuple[str, int, int, float]] = []
        for p in own + [(kind, 1 << 60, 1 << 60, 0.0)]:
            if run and p[1] >= max(r[2] for r in run):
                if len({r[1:3] for r in run}) > 1:
                    whole = (kind, min(r[1] for r in run), max(r[2] for r in run))
                    weights[whole] = weights.get(whole, 0.0) + sum(r[3] for r in run) / len(run)
                run = []
            run.append(p)
        for _, a, b, w in own:
            weights[kind, a, b] = weights.get((kind, a, b), 0.0) + w
    taken = [(a, b) for _, a, b in base]
    usable = []
    for (kind, a, b), w in weights.items():
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        joined = text[a - 1:a].isalnum() or text[b:b + 1].isalnum()  # part of a longer word
        if a < b and not joined and _passes(kind, text[a:b]) and not any(a < d and c < b for c, d in taken):
            usable.append((b, a, kind, w))
    usable.sort(key=lambda u: (u[0], u[1], KINDS.index(u[2])))
    ends = [u[0] for u in usable]
    best: list[tuple[float, tuple]] = [(0.0, ())]
    for i, (b, a, kind, w) in enumerate(usable):
        before = best[int(np.searchsorted(ends[:i], a, "right"))]
        with_it = (before[0] + w, (before[1], (kind, a, b)))
        best.append(with_it if with_it[0] > best[-1][0] else best[-1])
    chain, out = best[-1][1], []
    while chain:
        chain, span = chain
        out.append(span)
    return in_order(out)


def spans_of(texts: list[str], tagger: Tagger, batch: int = 256) -> list[tuple[list[Span], list[Span]]]:
    """(base, added) spans of every text."""
    base = [base_spans(t) if _TRIGGER.search(t) else [] for t in texts]
    proposals: list[list] = [[] for _ in texts]
    waiting: list[tuple[int, int, np.ndarray]] = []

    def decode() -> None:
        tags, sure = tagger.decode(np.stack([w[2] for w in waiting]))
        for (owner, start, _), t, s in zip(waiting, tags, sure):
            if t.any():
                proposals[owner] += _proposals(t, s, start, len(texts[owner]))
        waiting.clear()

    for i, text in enumerate(texts):
        places = window_places(text)
        if places:
            ids = characters(text)
            for p in places:
                waiting.append((i, p, _window(ids, p)))
                if len(waiting) == batch:
                    decode()
    if waiting:
        decode()
    return [(b, reconcile(t, p, b) if p else []) for t, p, b in zip(texts, proposals, base)]


# ---------------------------------------------------------------- training

def _sampled_windows(batches):
    """Windows of sampled texts: around base spans, around other digits, and one anywhere."""
    for batch in batches:
        windows, starts, ends, kinds = [], [], [], []
        for text, seed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rng = random.Random(seed)
            spans = base_spans(text)
            places = [max(0, a - rng.randrange(WINDOW - 10)) for _, a, _ in spans[:4]]
            others = window_places(text)
            places += rng.sample(others, min(2, len(others))) + [rng.randrange(max(len(text) - WINDOW, 1))]
            for p in places:
                inside = [(k, a - p, b - p) for k, a, b in spans if a < p + WINDOW and p < b]
                windows.append(text[p:p + WINDOW])
                kinds.append([k for k, _, _ in inside])
                starts.append([a for _, a, _ in inside])
                ends.append([b for _, _, b in inside])
        yield pa.record_batch({
            "window": pa.array(windows, pa.string()), "kinds": pa.array(kinds, pa.list_(pa.string())),
            "starts": pa.array(starts, pa.list_(pa.int32())), "ends": pa.array(ends, pa.list_(pa.int32()))})


def _number(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card_number(rng: random.Random) -> str:
    n = _number(rng, rng.choice((13, 14, 15, 15, 15, 18)))
    return next(n + d for d in "0123456789" if luhn(n + d))


def _planted(rng: random.Random) -> list[tuple[str, str]]:
    """One or two items of personal data, in forms that the base patterns find or miss."""
    def one() -> tuple[str, str]:
        kind = rng.choice(KINDS)
        if kind == "email":
            name = "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9)))
            host = "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(3, 8)))
            tail = rng.choice(("com", "org", "net", "de", "fr", "es"))
            name += rng.choice(("", ".", "_", "." + _number(rng, 2), "." + name[::-1]))
            at, dot = rng.choice((("@", "."), ("@", "."), (" @ ", "."), (" (at) ", " (dot) "), ("(at)", "(dot)"), ("[at]", "[dot]"),
                                  (" [at] ", "."), (" (at) ", "."), (" at ", " dot "), (" at ", " dot ")))
            return kind, f"{name}{at}{host}{rng.choice(('', *'123456789'))}{dot}{tail}"
        if kind == "ip":
            parts = [str(rng.randint(0, 255)) for _ in range(4)]
            return kind, rng.choice((".", ".", ".", "[.]", " . ", "-")).join(parts)
        if kind == "card":
            n, gap = _card_number(rng), rng.choice(("", "", " ", "-", ".", "  "))
            return kind, gap.join(n[i:i + 4] for i in range(0, len(n), 4))
        a, b, c = _number(rng, 3), _number(rng, 3), _number(rng, 4)
        code = rng.choice(("+1 ", "+1 ", "+1-", "+49 ", "+33.", "1 ", "001 ", "(+1) ", ""))
        return kind, code + rng.choice((f"({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}",
                                        f"{a}/{b}-{c}"))
    return [one() for _ in range(rng.choice((1, 1, 2)))]


def training_set(windows: list[tuple[str, list[Span]]], planted: int = PLANTED, seed: int = 17):
    """(character ids, tags) of labelled windows and of plain ones with planted items."""
    rng = random.Random(seed)
    plain = [w for w, spans in windows if not spans and not _TRIGGER.search(w)] or ["and the words of a text go on here "]
    ids, gold = [], []

    def add(text: str, spans: list[Span]) -> None:
        ids.append(_window(characters(text), 0))
        gold.append(_gold(spans, 0))

    for text, spans in windows:
        if not spans and (sum(c.isdigit() for c in text) >= 10 or _AT.search(fold(text))):
            continue  # what the base patterns miss is not evidence that there is nothing
        add(text, spans)
    for _ in range(planted):
        context = rng.choice(plain)
        at = context.find(" ", rng.randrange(max(len(context) // 2, 1))) + 1
        text, spans = context[:at], []
        for kind, item in _planted(rng):
            spans.append((kind, len(text), len(text) + len(item)))
            text += item + rng.choice((" ", " ", " ", ", ", "\n"))
        add((text + context[at:])[:WINDOW * 2], spans)
    for _ in range(planted // 2):  # digits that are no personal data
        context = rng.choice(plain)
        at = context.find(" ", rng.randrange(max(len(context), 1))) + 1
        junk = rng.choice((_number(rng, rng.randint(1, 6)), f"{_number(rng, 2)}.{_number(rng, 1)}",
                           f"20{_number(rng, 2)}-{_number(rng, 2)}-{_number(rng, 2)}", f"v{_number(rng, 1)}.{_number(rng, 2)}.{_number(rng, 1)}",
                           f"{_number(rng, 2)}:{_number(rng, 2)}", "at the dot", f"at {rng.choice(plain).split(' ')[0]}.", f"@{rng.choice(plain).split()[0] if plain[0].split() else 'a'}"))
        add(context[:at] + junk + " " + context[at:], [])
    return np.stack(ids).astype(np.int64), np.stack(gold).astype(np.int64)


def train(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS, planted: int = PLANTED,
          steps: int = STEPS) -> Tagger:
    """A tagger fitted on at most ``sample_docs`` different texts, those with the least hashes of a share."""
    ready(docs.sparkSession)
    texts = docs.where(F.col(text_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("t"), F.abs(F.xxhash64(text_col)).alias("seed"))
    rows = texts.count()
    places = 1_000_003
    some = texts.where(F.pmod(F.col("seed"), F.lit(places)) < int(places * min(1.0, 1.3 * sample_docs / max(rows, 1))))
    some = some.dropDuplicates(["seed"]).orderBy("seed", "t").limit(sample_docs)
    windows = some.mapInArrow(
        _sampled_windows, "window string, kinds array<string>, starts array<int>, ends array<int>")
    found = sorted((r["window"], list(zip(r["kinds"], r["starts"], r["ends"]))) for r in windows.collect())
    tagger = Tagger(_TAGS, _forbidden())
    tagger.fit(*training_set(found, planted), steps=steps)
    return tagger


# ---------------------------------------------------------------- whole tables

_FOUND = "array<struct<kind: string, start: long, end: long, base: boolean>>"


def find(docs: DataFrame, tagger: Tagger, text_col: str = "text", name: str = "pii") -> DataFrame:
    """Adds the spans of every text, by start and then kind, each with whether it is a base span."""
    ready(docs.sparkSession)

    @F.arrow_udf(_FOUND)
    def spans(texts: pa.Array) -> pa.Array:
        out = []
        for start, stop, _, _ in text_slices(texts):
            part = texts.slice(start, stop - start).fill_null("").to_pylist()
            for base, added in spans_of(part, tagger):
                known = set(base)
                out.append([{"kind": k, "start": a, "end": b, "base": (k, a, b) in known}
                            for k, a, b in in_order(base + added)])
        return pa.array(out, pa.list_(pa.struct([
            ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])))

    return docs.withColumn(name, spans(F.col(text_col).cast("string")))


def redact(docs: DataFrame, tagger: Tagger, text_col: str = "text") -> DataFrame:
    """The rows with every span of the text replaced by its kind in brackets."""
    ready(docs.sparkSession)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        out: list[str | None] = []
        for start, stop, _, _ in text_slices(texts):
            part = texts.slice(start, stop - start)
            rows = part.fill_null("").to_pylist()
            for known, text, (base, added) in zip(part.is_valid().to_pylist(), rows, spans_of(rows, tagger)):
                out.append(redacted(text, base + added) if known else None)
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, clean(F.col(text_col).cast("string")))


def redacted(text: str, spans: list[Span]) -> str:
    parts, at = [], 0
    for kind, a, b in in_order(spans):
        if a >= at:
            parts += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]]) if spans else text


def op1(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tagger = train(docs)
    found = find(docs.select("doc_id", "text"), tagger).drop("text")
    base = F.filter("pii", lambda s: s["base"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"),
        (F.size("pii") - F.size(base)).cast("long").alias("n_added"))
