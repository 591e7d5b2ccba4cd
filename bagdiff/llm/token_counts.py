"""Token counts through the distinct pre-tokens of a table, without making ids.

The vocabulary is a SentencePiece BPE model whose normaliser changes nothing but spaces
(``load`` refuses any other). No piece holds a space behind another character, a set of signs
(found from the pieces: line ends and digits, say) stands behind no other character in any
piece, and only few of them, the joining signs, before one. So no merge crosses the places before a run of
spaces, before a run of signs, or behind one that does not end with a joining sign. Texts are cut there into
pre-tokens, and the number of tokens of a text is the sum over its pre-tokens.

1. *Hot pre-tokens.* Every task hands on the pre-tokens that hold over ``1 / HOT_SHARE`` of its
   (row, pre-token) pairs; those whose sum over all tasks is over ``1 / HOT_SHARE`` of all pairs, so at most
   ``HOT_SHARE`` of them, are counted once and broadcast. Any with over ``2 / HOT_SHARE`` of all
   pairs is among them, as it has the rest of its pairs in tasks where it has too small a share.
2. *Frequencies.* Every row's pre-tokens with their frequencies are joined to these counts where the row is read.
3. *The others* move, one (row, pre-token, frequency) for each, are sorted by pre-token, and the
   pieces of each distinct one are counted once where its rows meet. None of them is hot.

Defined results: null reads as the empty text, which has no token and no byte. Rows are
counted one by one, so repeated rows give repeated results, null ids stay null, and other
columns are kept only where they are named in ``keep``. An empty table gives no row.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagdiff.llm.common import arrow_column, bound_batches, chunks, materialize, tidy

SPACE = "▁"
#: At most so many pre-tokens are broadcast, with keys of at most KEY_CHARS characters (a digest's has one more).
HOT_SHARE = 1 << 20
KEY_CHARS = 64
#: Distinct pre-tokens that a task holds while it counts them.
HELD = 1_000_000


class Model(NamedTuple):
    """A vocabulary file's bytes, the signs that no piece holds behind another character, and those that one holds before one."""

    data: bytes
    signs: str
    joining: str


def _fields(data: bytes):
    """(number, value) of each field of a protocol buffer message; fixed-size values as bytes."""
    at, n = 0, len(data)

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < n:
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield number, data[at : at + size]
        at += size


def load(path: str) -> Model:
    """Read a model; ValueError where counts could not be summed over pre-tokens."""
    with open(path, "rb") as f:
        data = f.read()
    # fixed values of the file format: message 1 a piece (1 text, 3 type), 2 the trainer (3 model type, 24 spaces as
    # suffix), 3 the normaliser (1 name, 3 space in front, 4 spaces removed, 5 spaces escaped); piece types 1 normal,
    # 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte; model type 2 BPE
    pieces, trainer, normal = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            held = dict(_fields(value))
            pieces.append((held[1].decode(), held.get(3, 1)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normal = dict(_fields(value))
    plain = [p for p, kind in pieces if kind in (1, 4)]
    wrong = {
        "not a BPE model": trainer.get(3) != 2 or trainer.get(24, 0),
        "the normaliser changes texts": normal.get(1) != b"identity" or normal.get(2),
        "no space in front": not normal.get(3, 1),
        "extra spaces are removed or not escaped": normal.get(4, 1) or not normal.get(5, 1),
        "user-defined pieces": any(kind == 4 for _, kind in pieces),
        "no byte pieces": sum(kind == 6 for _, kind in pieces) != 256,
        "no piece for a space": SPACE not in plain,
        "pieces with a space behind another character": any(SPACE in p.lstrip(SPACE) for p in plain),
        "pieces with a line feed": any("\n" in p for p in plain),
    }
    if any(wrong.values()):
        raise ValueError(f"{path}: " + ", ".join(k for k, v in wrong.items() if v))
    beside = {pair for p in plain for pair in zip(p.lstrip(SPACE), p.lstrip(SPACE)[1:], strict=False)}
    signs = {chr(c) for c in range(128) if not chr(c).isalpha() and chr(c) != " "}
    while behind := {b for a, b in beside if a not in signs and b in signs}:
        signs -= behind
    joining = {a for a, b in beside if a in signs and b not in signs}
    return Model(data, "".join(sorted(signs)), "".join(sorted(joining)))


class _Cutter:
    """Pre-tokens of texts; a space in front is part of a text that is not empty."""

    def __init__(self, model: Model):
        sign, other = f"[{re.escape(model.signs)}]", f"[^ {re.escape(model.signs)}]"
        run = f"{other}+|{sign}+"
        if model.joining:
            run = f"{other}+|{sign}*[{re.escape(model.joining)}]{other}+|{sign}+"
        self.find = re.compile(f" +(?:{run})?|{run}").findall

    def __call__(self, text: str) -> list[str]:
        return self.find(" " + text.replace(SPACE, " ")) if text else []


def _key(token: str) -> str:
    if len(token) <= KEY_CHARS:
        return token
    import hashlib

    # so long a run of signs and letters is no pre-token, and no other key is of this length
    return "#" + hashlib.blake2b(token.encode(), digest_size=32).hexdigest()


def _pieces(model: Model):
    """Function from pre-tokens to their numbers of pieces."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model.data)
    alone = len(library.encode("\n"))  # the space in front, and the line feed's

    def count(tokens: list[str]) -> list[int]:
        # the library puts a space in front; a token without one goes behind a line feed, which no piece holds
        asked = [t[1:] if t[0] == " " else "\n" + t for t in tokens]
        return [
            1 if t == " " else len(ids) - (0 if t[0] == " " else alone)
            for t, ids in zip(tokens, library.encode(asked), strict=True)
        ]

    return count


def hot_pre_tokens(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``key, pieces`` of the pre-tokens with over ``1 / HOT_SHARE`` of all (row, pre-token) pairs in the tasks where they are frequent."""
    model = load(path)
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def frequent(batches):
        from collections import Counter

        import pyarrow as pa

        def rows(counts, total):
            tokens = [t for t, n in counts.items() if n * HOT_SHARE > total]
            keys = [_key(t) for t in tokens]
            whole = [None if k is t else t for k, t in zip(keys, tokens, strict=True)]
            own = [*[counts[t] for t in tokens], total]  # the last row has the sum of all pairs
            data = [pa.array([*keys, None], pa.string()), pa.array([*whole, None], pa.string()), pa.array(own, pa.int64())]
            return pa.RecordBatch.from_arrays(data, names=["key", "token", "rows"])

        cut, counts, total = _Cutter(shared.value), Counter(), 0
        for batch in batches:
            for _, part in chunks(batch.column(0)):
                for t in part:
                    own = set(cut(t))
                    total += len(own)
                    counts.update(own)
                if len(counts) > HELD:
                    yield rows(counts, total)
                    counts, total = Counter(), 0
        yield rows(counts, total)

    def count(batches):
        import pyarrow as pa

        ask = _pieces(shared.value)
        for tokens in batches:
            yield pa.array([n for _, part in chunks(tokens) for n in ask(part)], pa.int64())

    seen = df.select(F.col(text).alias("__text")).mapInArrow(tidy(frequent), "key string, token string, rows bigint")
    sums = materialize(seen.groupBy("key", "token").agg(F.sum("rows").alias("rows")), "pre_token_rows", narrow=True)
    total = sums.where(F.col("key").isNull()).agg(F.sum("rows")).first()[0] or 0
    hot = sums.where(F.col("key").isNotNull() & (F.col("rows") > total // HOT_SHARE))
    return hot.select("key", arrow_column(count, "bigint", F.coalesce("token", "key")).alias("pieces"))


def count_tokens(df: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``df`` with ``n_bytes`` (of the text in UTF-8) and ``n_tokens`` for each row."""
    context = df.sparkSession.sparkContext
    model = context.broadcast(load(path))
    shared = context.broadcast({r.key: r.pieces for r in hot_pre_tokens(df, path, text).toLocalIterator()})

    def frequencies(batches):
        from collections import Counter

        import pyarrow as pa

        cut, known = _Cutter(model.value), shared.value
        pair = pa.struct([("token", pa.string()), ("n", pa.int64())])
        kind = pa.struct([("known", pa.int64()), ("rest", pa.list_(pair))])
        for texts in batches:
            for _, part in chunks(texts):
                sums, tokens, times, ends = [], [], [], [0]
                for t in part:
                    summed = 0
                    for token, n in Counter(cut(t)).items():
                        pieces = known.get(token if len(token) <= KEY_CHARS else _key(token))
                        if pieces is None:
                            tokens.append(token)
                            times.append(n)
                        else:
                            summed += n * pieces
                    sums.append(summed)
                    ends.append(len(tokens))
                rest = pa.StructArray.from_arrays([pa.array(tokens, pa.string()), pa.array(times, pa.int64())], fields=list(pair))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)
                yield pa.StructArray.from_arrays([pa.array(sums, pa.int64()), lists], fields=list(kind))

    def counted(batches):
        import numpy as np
        import pyarrow as pa

        ask, last, pieces = _pieces(model.value), None, 0
        for batch in batches:
            held = batch.column(0).dictionary_encode()
            distinct = held.dictionary.to_pylist()
            new = distinct[1:] if distinct and distinct[0] == last else distinct  # a token goes on in the next batch
            counts = [pieces] * (len(distinct) - len(new)) + [n for n in ask(new)] if distinct else []
            if distinct:
                last, pieces = distinct[-1], counts[-1]
            own = np.array(counts, np.int64)[held.indices.to_numpy()] * batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(own, pa.int64())], names=["__row", "tokens"])

    made = arrow_column(frequencies, "struct<known:bigint,rest:array<struct<token:string,n:bigint>>>", F.col(text))
    kept = [F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)]
    size = F.coalesce(F.octet_length(F.col(text)).cast("bigint"), F.lit(0).cast("bigint"))
    rows = df.select(*kept, size.alias("__bytes"), made.alias("__made"))
    # numbered on writing, so that the sums below find their rows whatever is run again
    rows = materialize(rows.select("*", F.monotonically_increasing_id().alias("__row")), "token_frequencies")
    rest = rows.select("__row", F.explode("__made.rest").alias("__one")).select("__one.token", "__row", "__one.n")
    met = rest.repartition("token").sortWithinPartitions("token").mapInArrow(tidy(counted), "__row bigint, tokens bigint")
    more = met.groupBy("__row").agg(F.sum("tokens").alias("__more"))
    named = [F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)]
    summed = F.col("__made.known") + F.coalesce("__more", F.lit(0))
    return rows.join(more, "__row", "left").select(*named, F.col("__bytes").alias("n_bytes"), summed.alias("n_tokens"))
