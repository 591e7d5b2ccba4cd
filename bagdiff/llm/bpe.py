"""Byte-level BPE with a pair occurrence index.

A task gathers the distinct pieces of a batch of whole texts (a vocabulary file's
pre-tokenizer pattern cuts the texts), lays their bytes out as one array of
symbols, and maps each adjacent pair to all its positions. Active ranks are applied
in ascending order: all positions of a pair merge at once, and only the lists of
the pairs beside them change. As each token has one merge, and that merge's rank
is above those of its parts, no merge can call for a lower rank than its own; so
this order gives every piece what merging it alone would give. Pieces once encoded
are remembered up to a bound.

The vocabulary is read from a file in the ``tokenizers`` JSON form, whose path is a
parameter, on the driver alone, and broadcast (a few MB, bounded by the file).

Defined results: a null text encodes as the empty one, to no ids. Special tokens in
a text become their ids (they are matched before anything else, as that library
does by default). Decoding joins the tokens' bytes, reading malformed UTF-8 as
U+FFFD; unknown ids decode to nothing. Repeated rows are encoded each for itself.
Other columns are kept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagdiff.llm.common import arrow_column, chunks, give_back

#: Distinct units that a task remembers, and characters that it encodes together.
REMEMBERED = 250_000
TOGETHER = 2_000_000

#: Unicode white space, as the pre-tokenizer reads it.
_WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: the byte-level pre-tokenizer's pattern.
_PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)


@dataclass
class Vocabulary:
    """ids of the 256 bytes; (a, b) -> (rank, id) as sorted keys a << 32 | b; bytes of each id; special texts."""

    byte_ids: object
    pair_keys: object
    pair_ranks: object
    rank_ids: object
    rank_pairs: object
    token_bytes: list
    special: dict


def _byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    chars, extra = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in chars:
            chars[b], extra = chr(extra), extra + 1
    return [chars[b] for b in range(256)]


def load(path: str) -> Vocabulary:
    """Read a byte-level BPE file; anything in it that would change results and isn't supported is refused."""
    import numpy as np

    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    model, pre = held["model"], held["pre_tokenizer"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre.get("add_prefix_space") or held["normalizer"]:
        raise ValueError("a byte-level BPE file without normalizer and prefix space is needed")
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        raise ValueError("this BPE file has options that are not supported")
    if not pre.get("use_regex", True) or (held.get("decoder") or {}).get("type") != "ByteLevel":
        raise ValueError("pre-tokens by the byte-level pattern and a byte-level decoder are needed")
    # without a normalizer, added tokens are looked for in the same text whether normalized or not
    if any(t.get(k) for t in held["added_tokens"] for k in ("lstrip", "rstrip", "single_word")):
        raise ValueError("added tokens that take white space or whole words alone are not supported")
    vocab, chars = model["vocab"], _byte_chars()
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = {a + b: i for i, (a, b) in enumerate(merges)}
    if len(made) != len(merges) or any(made.get(x, -1) >= i for i, m in enumerate(merges) for x in m):
        raise ValueError("each token needs one merge, after those of its parts")
    pairs = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
    order = np.argsort(pairs)
    back = {c: b for b, c in enumerate(chars)}
    special = {t["content"]: t["id"] for t in held["added_tokens"]}
    tokens = [b""] * (1 + max([*vocab.values(), *special.values()]))
    for t, i in vocab.items():
        tokens[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
    for t, i in special.items():
        tokens[i] = t.encode()
    return Vocabulary(
        np.array([vocab[c] for c in chars], np.int64),
        pairs[order],
        order.astype(np.int64),
        np.array([vocab[a + b] for a, b in merges], np.int64),
        pairs,
        tokens,
        special,
    )


def _ranks(vocab, left, right):
    """Rank of each adjacent pair, -1 where there is no merge."""
    import numpy as np

    key = (left.astype(np.int64) << 32) | right
    at = np.minimum(np.searchsorted(vocab.pair_keys, key), len(vocab.pair_keys) - 1)
    return np.where((vocab.pair_keys[at] == key) & (right >= 0), vocab.pair_ranks[at], -1).astype(np.int32)


def _merge_all(vocab, data: bytes, ends):
    """Ids of concatenated pieces and how many each piece has. ``ends``: where each piece ends."""
    import heapq

    import numpy as np

    n = len(data)
    kind = np.int32 if n < 1 << 31 else np.int64  # of places
    symbol = vocab.byte_ids.astype(np.int32)[np.frombuffer(data, np.uint8)]
    after = np.arange(1, n + 1, dtype=kind)
    after[ends - 1] = n  # the place after a piece's last symbol is a stop
    before = np.arange(-1, n - 1, dtype=kind)
    before[np.concatenate(([0], ends[:-1]))] = n
    symbol = np.append(symbol, np.int32(-1))
    rank = _ranks(vocab, symbol[:n], symbol[after])
    rank = np.append(rank, np.int32(-1))
    # the index: rank -> arrays of positions; a position is live there while rank[position] says so.
    # Symbols only grow, so a position never comes back to a pair it has left.
    index, queue, merged = {}, [], np.zeros(n + 1, bool)

    def enter(places):
        got = rank[places]
        places, got = places[got >= 0], got[got >= 0]
        if not len(places):
            return
        order = np.argsort(got, kind="stable")
        places, got = places[order], got[order]
        cuts = np.flatnonzero(np.diff(got)) + 1
        for r, part in zip(got[np.concatenate(([0], cuts))].tolist(), np.split(places, cuts), strict=True):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(queue, r)

    enter(np.arange(n, dtype=kind))
    while queue:
        r = heapq.heappop(queue)
        held = index.pop(r)
        at = held[0] if len(held) == 1 else np.concatenate(held)
        at = at[rank[at] == r]
        if not len(at):
            continue
        pair = int(vocab.rank_pairs[r])
        if pair >> 32 == pair & 0xFFFFFFFF and len(at) > 1:  # a run of one symbol merges two by two from its left
            at = np.sort(at)
            joined = np.concatenate(([False], after[at[:-1]] == at[1:]))
            run = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
        gone = after[at]
        far = after[gone]
        symbol[at] = vocab.rank_ids[r]
        symbol[gone] = -1
        rank[gone] = -1
        after[at] = far
        inner = far < n
        before[far[inner]] = at[inner]
        rank[at] = _ranks(vocab, symbol[at], symbol[far])
        near = before[at]
        merged[at] = True
        near = near[(near < n) & ~merged[near]]
        merged[at] = False
        rank[near] = _ranks(vocab, symbol[near], symbol[after[near]])
        enter(np.concatenate((at, near)) if len(near) else at)
    live = symbol[:n] >= 0
    total = np.concatenate(([0], np.cumsum(live)))
    starts = np.concatenate(([0], ends[:-1]))
    return symbol[:n][live], total[ends] - total[starts]


class _Numbers(dict):
    """Numbers units as they are first asked for; ``new`` has those since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new = []

    def __missing__(self, unit):
        number = self[unit] = len(self)
        self.new.append(unit)
        return number


class _Encoder:
    """Encodes batches of texts; remembers the ids of pieces of earlier ones."""

    def __init__(self, vocab):
        import re

        import regex

        self.vocab = vocab
        # a run of white space and what follows up to the next one: no piece crosses its ends
        self.units = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+").findall
        self.pieces = regex.compile(_PIECES).findall
        by_length = sorted(vocab.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, by_length)) + ")").split if by_length else None
        self.forget()

    def forget(self):
        import numpy as np

        self.known, self.flat = _Numbers(), np.zeros(0, np.int32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _cut(self, text):
        """Units of a text, with special tokens as ids."""
        if self.special is None or not any(s in text for s in self.vocab.special):
            return self.units(text)
        out = []
        for i, part in enumerate(self.special(text)):
            if i % 2:
                out.append(self.vocab.special[part])
            else:
                out += self.units(part)
        return out

    def _learn(self, new):
        """Encode units not met before: through their distinct pieces, all at once."""
        import numpy as np

        numbers, flat, per_unit = {}, [], []
        number = numbers.setdefault
        for unit in new:
            # letters, with a space before them or none, are one piece
            if isinstance(unit, int) or unit.isalpha() or (unit[0] == " " and unit[1:].isalpha()):
                flat.append(number(unit, len(numbers)))
                per_unit.append(1)
            else:
                parts = self.pieces(unit)
                for p in parts:
                    flat.append(number(p, len(numbers)))
                per_unit.append(len(parts))
        texts = [p for p in numbers if not isinstance(p, int)]
        raw = [p.encode() for p in texts]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        ids, sizes = _merge_all(self.vocab, b"".join(raw), np.cumsum(lens)) if raw else (np.zeros(0, np.int64), lens)
        # special ids stand for themselves, after the pieces
        place = {p: i for i, p in enumerate([*texts, *[p for p in numbers if isinstance(p, int)]])}
        extra = np.array([p for p in numbers if isinstance(p, int)], np.int64)
        ids, sizes = np.concatenate((ids, extra)), np.concatenate((sizes, np.ones(len(extra), np.int64)))
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        order = np.array([place[p] for p in numbers], np.int64)
        which = order[np.array(flat, np.int64)]
        per_unit = np.array(per_unit, np.int64)
        made = ids[_spans(starts[which], sizes[which])].astype(np.int32)
        total = np.concatenate(([0], np.cumsum(sizes[which])))
        last = np.cumsum(per_unit)
        unit_sizes = total[last] - total[last - per_unit]
        unit_starts = len(self.flat) + np.concatenate(([0], np.cumsum(unit_sizes)))[:-1]
        self.flat = np.concatenate((self.flat, made))
        self.starts = np.concatenate((self.starts, unit_starts))
        self.sizes = np.concatenate((self.sizes, unit_sizes))

    def encode(self, texts):
        """Little-endian 32-bit ids of each text, as bytes."""
        import numpy as np

        if len(self.known) > REMEMBERED:
            self.forget()
        # a text's units are numbered at once, so that those of one text only are held as strings
        numbered = []
        for t in texts:
            cut = self._cut(t)
            numbered.append(np.fromiter(map(self.known.__getitem__, cut), np.int32, len(cut)))
        cut = None
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        out = []
        for at in numbered:
            out.append(self.flat[_spans(self.starts[at], self.sizes[at])].astype("<u4").tobytes())
        return out


def _spans(starts, sizes):
    """The numbers start, start + 1, ... of each span, one span after the other."""
    import numpy as np

    total = int(sizes.sum())
    shift = starts - np.concatenate(([0], np.cumsum(sizes)))[:-1]
    return np.repeat(shift, sizes) + np.arange(total)


def _decode(ids: bytes, tokens: list) -> str:
    import numpy as np

    known = len(tokens)
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist() if i < known]).decode("utf-8", "replace")


def _encoded(encoder, texts) -> Iterator[list[bytes]]:
    for _, part in chunks(texts, TOGETHER):
        yield encoder.encode(part)


def encode(df: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with a binary column ``into``: the text's ids as little-endian unsigned 32-bit integers."""
    shared = df.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        import pyarrow as pa

        encoder = _Encoder(shared.value)
        for texts in batches:
            for ids in _encoded(encoder, texts):
                yield pa.array(ids, pa.binary())
            give_back()

    return df.withColumn(into, arrow_column(run, "binary", F.col(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with a string column ``into``: the text of packed ids, special tokens included. Null stays null."""
    shared = df.sparkSession.sparkContext.broadcast(load(path).token_bytes)

    def run(batches):
        import pyarrow as pa

        for held in batches:
            for s in range(0, len(held), 256):
                part = held.slice(s, 256).to_pylist()
                yield pa.array([None if x is None else _decode(x, shared.value) for x in part], pa.string())

    return df.withColumn(into, arrow_column(run, "string", F.col(ids)))


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts: ``df`` with both columns."""
    shared = df.sparkSession.sparkContext.broadcast(load(path))

    def run(batches):
        import pyarrow as pa

        encoder, tokens = _Encoder(shared.value), shared.value.token_bytes
        kind = pa.struct([("ids", pa.binary()), ("decoded", pa.string())])
        for texts in batches:
            for packed in _encoded(encoder, texts):
                back = pa.array([_decode(x, tokens) for x in packed], pa.string())
                yield pa.StructArray.from_arrays([pa.array(packed, pa.binary()), back], fields=list(kind))
            give_back()

    tried = df.withColumn("__bpe", arrow_column(run, "struct<ids:binary,decoded:string>", F.col(text)))
    return tried.withColumns({ids: F.col("__bpe.ids"), decoded: F.col("__bpe.decoded")}).drop("__bpe")


def n_tokens(ids: Column) -> Column:
    return F.shiftright(F.octet_length(ids).cast("bigint"), 2)
