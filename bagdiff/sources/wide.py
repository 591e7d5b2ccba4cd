"""What the reader of UTF-16 and UTF-32 files does inside tasks, on rows in the order of the scan.

The functions are shipped by value, so executors need no copy of the package on their path.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What :func:`measured` returns; the arrays have one value for each offset.
MEASURED = "_f string, _b long, _m0 long, _m1 long, _size long, _n array<long>, _first array<long>, _last array<long>"
#: What :func:`joined` returns.
JOINED = "_f string, line_no long, _raw binary"


def _runs(*columns):
    """(first, end) of the rows in which the columns do not change."""
    import numpy as np
    import pyarrow.compute as pc

    rows = len(columns[0])
    starts = {0, rows}
    for c in columns:
        changed = pc.not_equal(c.slice(1), c.slice(0, max(0, rows - 1)))
        starts.update((np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1).tolist())
    at = sorted(starts)
    return zip(at, at[1:])


def measured(unit: int):
    """One row for each block of a scan's ``_f, _b, _m, _size``: its row ids, its bytes, and for each
    offset that the block may have the number of its aligned cuts and the row ids of the first and last of them."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def row(b):
            values = [[v] for v in (b["f"], b["b"], b["m0"], b["m1"], b["size"], b["n"], b["first"], b["last"])]
            many = pa.list_(pa.int64())
            kinds = [pa.string(), *[pa.int64()] * 4, many, many, many]
            names = ["_f", "_b", "_m0", "_m1", "_size", "_n", "_first", "_last"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

        block = None
        for batch in batches:
            files, starts = batch.column("_f"), batch.column("_b")
            ids, sizes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_m", "_size"))
            for a, e in _runs(files, starts) if batch.num_rows else ():
                f, b = files[a].as_py(), starts[a].as_py()
                if block is None or (f, b) != (block["f"], block["b"]):
                    if block is not None:
                        yield row(block)
                    none = [None] * unit
                    block = {"f": f, "b": b, "m0": int(ids[a]), "size": 0, "n": [0] * unit, "first": [*none], "last": [*none]}
                ends = block["size"] + np.cumsum(sizes[a:e], dtype=np.int64)
                for offset in range(unit):
                    cuts = np.flatnonzero((ends + offset) % unit == 0)
                    if len(cuts):
                        if not block["n"][offset]:
                            block["first"][offset] = int(ids[a + cuts[0]])
                        block["last"][offset] = int(ids[a + cuts[-1]])
                        block["n"][offset] += len(cuts)
                block["size"], block["m1"] = int(ends[-1]), int(ids[e - 1])
        if block is not None:
            yield row(block)

    return run


def joined(unit: int):
    """The lines of a scan's ``_f, _m0, _line, _after, _raw``, with their line feed: the rows of a block (``_m0``) that
    hold its whole lines, the first with the number ``_line``. The last has the number before ``_after``."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        block, number, after, phase, held = None, 0, 0, 0, []

        def check():
            if number != after or phase or held:
                raise RuntimeError("the scan's rows came otherwise than when its blocks were measured")

        def lines(file, first, values):
            numbers = pa.array(np.arange(first, first + len(values), dtype=np.int64))
            return pa.RecordBatch.from_arrays([pa.repeat(file, len(values)), numbers, values], names=["_f", "line_no", "_raw"])

        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column("_raw")
            large = pa.types.is_large_binary(raw.type)
            kind, width = (pa.large_binary(), np.int64) if large else (pa.binary(), np.int32)
            _, places, data = raw.buffers()
            places = np.frombuffer(places, width)[raw.offset : raw.offset + batch.num_rows + 1]
            for a, e in _runs(batch.column("_m0")):
                if batch.column("_m0")[a].as_py() != block:
                    check()
                    block, number, after = (batch.column(c)[a].as_py() for c in ("_m0", "_line", "_after"))
                file = batch.column("_f")[a]
                # the column's bytes are those of the file, so a line is a slice that ends at an aligned cut
                ends = places[a + 1 : e + 1]
                cuts = ends[(ends.astype(np.int64) - places[a] + phase) % unit == 0]
                phase = int(phase + ends[-1] - places[a]) % unit
                begin = int(places[a])
                if held and len(cuts):
                    held.append(data.slice(begin, int(cuts[0]) - begin))
                    yield lines(file, number, pa.array([b"".join(held)], kind))
                    number, held, begin, cuts = number + 1, [], int(cuts[0]), cuts[1:]
                if len(cuts):
                    bounds = pa.py_buffer(np.concatenate([[begin], cuts]).astype(width))
                    yield lines(file, number, pa.Array.from_buffers(kind, len(cuts), [None, bounds, data]))
                    number, begin = number + len(cuts), int(cuts[-1])
                if begin < ends[-1]:
                    held.append(data.slice(begin, int(ends[-1]) - begin).to_pybytes())
        check()

    return run
