"""Secrets in texts: fixed patterns, and a character convolutional network over every other candidate.

*Patterns* (base findings): ``assign``, ``access`` and ``hex``, matched leftmost and
non-overlapping per kind; they always stay.

*Candidates* are runs of at least ``CANDIDATE`` token characters, with a digit or not, or what
base spans leave of them, if it is as long. The network reads each candidate whole, in
windows of ``OWN`` characters, ``STEP`` apart, those at its ends with the text around
it, and each of its segments between '/', '=' and '.' by itself; the largest score of
these counts: embedded characters, one convolution, the largest response inside and
outside the candidate, and a logistic output. It is trained on the driver, in
numpy, on labelled findings: windows of what patterns found in runs, and of runs in
which they found nothing, from all documents, the ``FINDINGS`` of each label with the
smallest hashes. For half of the training windows the text around is blanked, so that a
candidate's own shape counts. On findings kept apart (one in four, by a hash of what
was found), with and without the text around, the output is calibrated (a logistic fit).
The threshold is the largest that still finds ``RECALL`` of all true findings of the
table but those trained on, with and without the text around: a quantile of their
scores, to one in ``RANKS`` of their number. Candidates at or above it
become spans of kind ``net``; none touches a base span.

Texts are scanned whole; character classes are found over a batch at once in numpy.

Defined results: a null text reads as empty and has no findings. If training
finds no true or no false candidate there is no network, and base findings alone
remain. Repeated rows are scanned each for itself; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagdiff.llm.common import arrow_column, bound_batches, chunks, materialize, tidy

CANDIDATE = 12
#: Bound of the training sample: findings of each label.
FINDINGS = 3_000
RECALL = 0.98
#: Accuracy of the threshold's rank among all true findings.
RANKS = 100_000
LEFT, HEAD, TAIL, RIGHT = 24, 24, 16, 12
#: Characters of a candidate in one window, and the distance of its windows.
OWN = HEAD + TAIL
STEP = OWN // 2
#: Windows that are held in expanded form at once.
BATCH = 2048
WIDTH, FILTERS, EMBED = 5, 16, 8

#: The base patterns, the length each needs, and the group it is measured on.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
KINDS = ("assign", "access", "hex", "net")
NEEDED = {"assign": 12, "access": 18, "hex": 16}

_SPAN = "struct<kind:string,start:int,end:int,score:double>"


def _tables():
    """Class bits of the first 128 code points: 1 hex digit, 2 token character."""
    import numpy as np

    out = np.zeros(129, np.uint8)
    for i in range(128):
        c = chr(i)
        out[i] = (c in "0123456789abcdef") | (2 * (c.isalnum() or c in "+/_.=-"))
    return out


def _runs(mask, least):
    """(start, end) of the runs of true of at least ``least``."""
    import numpy as np

    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def _find(texts, table, assign, access):
    """For each text: base spans [(start, kind number, end)] in order, and candidates [(start, end)]."""
    import numpy as np

    lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    ends = np.cumsum(lens)
    points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    kinds = table[np.minimum(points, 128)]
    base = [[] for _ in texts]
    candidates = [[] for _ in texts]
    starts, stops = _runs((kinds & 1).astype(bool), NEEDED["hex"])
    owner = np.searchsorted(ends, starts, side="right")
    begin = ends - lens
    for s, e, o in zip(starts.tolist(), stops.tolist(), owner.tolist(), strict=True):
        base[o].append((s - int(begin[o]), 2, e - int(begin[o])))
    starts, stops = _runs((kinds & 2).astype(bool), CANDIDATE)
    owner = np.searchsorted(ends, starts, side="right")
    for s, e, o in zip(starts.tolist(), stops.tolist(), owner.tolist(), strict=True):
        candidates[o].append((s - int(begin[o]), e - int(begin[o])))
    for i, t in enumerate(texts):
        low = t.lower()
        if any(k in low for k in KEYWORDS):
            for m in assign.finditer(t):
                if len(m.group(2)) >= NEEDED["assign"]:
                    base[i].append((m.start(), 0, m.end()))
        if "AKIA" in t:
            for m in access.finditer(t):
                if m.end() - m.start() >= NEEDED["access"]:
                    base[i].append((m.start(), 1, m.end()))
        base[i].sort()
    return base, candidates


def _patterns():
    import re

    return re.compile(ASSIGN, re.ASCII), re.compile(ACCESS)  # ASCII: no other letter counts as a case of these


def _window(text, start, end):
    """The characters the network reads: left, head, tail, right; blanks where there are none."""
    head, tail = text[start:end][:HEAD], text[max(start + HEAD, end - TAIL) : end]
    left, right = text[max(0, start - LEFT) : start], text[end : end + RIGHT]
    return left.rjust(LEFT, "\0") + head.ljust(HEAD, "\0") + tail.ljust(TAIL, "\0") + right.ljust(RIGHT, "\0")


def _windows(text, start, end):
    """Overlapping windows over all of a candidate, then over each of its segments, these without what is around them."""
    yield from _over(text, start, end)
    for s, e in _segments(text, start, end):
        if CANDIDATE <= e - s < end - start:
            yield from _over(text[s:e], 0, e - s)


def _over(text, start, end):
    """Windows OWN long at most; only those at the ends see the text around."""
    last = max(start, end - OWN)
    for s in (*range(start, last, STEP), last):
        e = min(s + OWN, end)
        left = text[max(0, s - LEFT) : s] if s == start else ""
        right = text[e : e + RIGHT] if e == end else ""
        yield _window(left + text[s:e] + right, len(left), len(left) + e - s)


def _segments(text, start, end):
    """(start, end) between the characters '/', '=' and '.' of a candidate."""
    at = start
    for i in range(start, end):
        if text[i] in "/=.":
            yield at, i
            at = i + 1
    yield at, end


def _parts(runs, base):
    """Runs cut at base spans: [(start, end, label)] of at least CANDIDATE characters, in order.

    The label is true inside base spans, false for a run without any, and None for what they leave of a run.
    """
    covered = []
    for s, _, e in base:  # in order
        if covered and s <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], e)
        else:
            covered.append([s, e])
    out, first = [], 0
    for start, end in runs:
        while first < len(covered) and covered[first][1] <= start:
            first += 1
        at, k = start, first
        while k < len(covered) and covered[k][0] < end:
            s, e = max(covered[k][0], start), min(covered[k][1], end)
            out += [(at, s, None), (s, e, True)]
            at, k = e, k + 1
        out.append((at, end, None if k > first else False))
    return [x for x in out if x[1] - x[0] >= CANDIDATE]


def _codes(windows):
    """Windows as character numbers: printable ASCII, 1 for other characters, 0 for blanks."""
    import numpy as np

    points = np.frombuffer("".join(windows).encode("utf-32-le"), np.uint32).reshape(len(windows), -1)
    shown = (points >= 32) & (points < 127)
    return np.where(shown, points - 30, np.where(points == 0, 0, 1)).astype(np.int64)


def _alone(codes):
    """Windows with the text around blanked."""
    out = codes.copy()
    out[:, :LEFT] = 0
    out[:, -RIGHT:] = 0
    return out


@dataclass
class Network:
    """Weights, calibration (slope, shift) of the output, and the threshold on the calibrated score."""

    embed: object
    kernel: object
    bias: object
    out: object
    shift: float
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 0.5

    @classmethod
    def start(cls, seed: int = 1):
        import numpy as np

        rng = np.random.default_rng(seed)
        return cls(
            rng.normal(0, 0.3, (97, EMBED)),
            rng.normal(0, 0.2, (WIDTH * EMBED, FILTERS)),
            np.zeros(FILTERS),
            rng.normal(0, 0.2, 2 * FILTERS),
            0.0,
        )

    def _forward(self, codes):
        import numpy as np

        n, length = codes.shape
        steps = length - WIDTH + 1
        seen = self.embed[codes] * (codes > 0)[:, :, None]
        cols = np.concatenate([seen[:, i : i + steps] for i in range(WIDTH)], axis=2)
        made = np.maximum(cols @ self.kernel + self.bias, 0)
        own = slice(LEFT, LEFT + HEAD + TAIL - WIDTH + 1)
        inner = made[:, own].argmax(axis=1) + LEFT
        around = made.copy()
        around[:, own] = -1
        outer = around.argmax(axis=1)
        pick = np.arange(n)[:, None], np.arange(FILTERS)[None, :]
        top = np.concatenate((made[pick[0], inner, pick[1]], made[pick[0], outer, pick[1]]), axis=1)
        return cols, inner, outer, top, top @ self.out + self.shift

    def raw(self, codes):
        import numpy as np

        return np.concatenate([self._forward(codes[s : s + BATCH])[-1] for s in range(0, len(codes), BATCH)])

    def score(self, codes):
        import numpy as np

        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(codes) + self.offset, -30, 30)))

    def train(self, codes, labels, epochs: int = 12, seed: int = 1):
        """Adam on the logistic loss; the text around is blanked for half of the windows."""
        import numpy as np

        rng = np.random.default_rng(seed)
        weights = [self.embed, self.kernel, self.bias, self.out, np.zeros(1)]
        first = [np.zeros_like(w) for w in weights]
        second = [np.zeros_like(w) for w in weights]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(codes))
            for s in range(0, len(order), 128):
                at = order[s : s + 128]
                x, y = codes[at].copy(), labels[at]
                hide = rng.random(len(at)) < 0.5
                x[hide] = _alone(x[hide])
                self.shift = float(weights[4][0])
                cols, inner, outer, top, raw = self._forward(x)
                wrong = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) / len(at)
                d_top = wrong[:, None] * self.out[None, :] * (top > 0)
                d_kernel, d_bias = np.zeros_like(self.kernel), np.zeros_like(self.bias)
                d_embed = np.zeros_like(self.embed)
                for places, d in ((inner, d_top[:, :FILTERS]), (outer, d_top[:, FILTERS:])):
                    got = cols[np.arange(len(at))[:, None], places]  # n, filters, width * embed
                    d_kernel += np.einsum("nfk,nf->kf", got, d)
                    d_bias += d.sum(axis=0)
                    d_cols = d[:, :, None] * self.kernel.T[None]
                    for i in range(WIDTH):
                        chars = x[np.arange(len(at))[:, None], places + i]
                        part = d_cols[:, :, i * EMBED : (i + 1) * EMBED] * (chars > 0)[:, :, None]
                        np.add.at(d_embed, chars, part)
                grads = [d_embed, d_kernel + 1e-4 * self.kernel, d_bias, top.T @ wrong, np.array([wrong.sum()])]
                step += 1
                for w, g, a, b in zip(weights, grads, first, second, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    w -= 0.005 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
        self.shift = float(weights[4][0])

    def calibrate(self, codes, labels, recall: float):
        """Logistic fit of the output, then the largest threshold that still finds ``recall`` of the true ones."""
        import numpy as np

        raw = self.raw(codes)
        a, b = 1.0, 0.0
        for _ in range(300):
            p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
            a -= 0.05 * (((p - labels) * raw).mean() / (1 + (raw**2).mean()) * 10 + 1e-3 * (a - 1))
            b -= 0.5 * (p - labels).mean()
        self.slope, self.offset = max(a, 1e-3), b
        true = np.sort(self.score(codes[labels > 0]))
        self.threshold = float(true[int((1 - recall) * len(true))])


def _apart(found):
    """Whether what was found is kept apart from training."""
    from zlib import crc32

    return crc32(found.encode()) % 4 == 3


class _Smallest:
    """The ``most`` distinct strings with the smallest hashes of those added."""

    def __init__(self, most):
        self.most, self.heap, self.held = most, [], {}

    def add(self, text, apart=False):
        """Add ``text``; it is kept apart if every finding that it was added for is, in whatever order they come."""
        from hashlib import blake2b
        from heapq import heappush, heappushpop

        if text in self.held:
            self.held[text] = self.held[text] and apart
            return
        entry = (-int.from_bytes(blake2b(text.encode(), digest_size=7).digest()), text)
        if len(self.heap) == self.most and entry <= self.heap[0]:
            return
        self.held[text] = apart
        if len(self.heap) < self.most:
            heappush(self.heap, entry)
        else:
            del self.held[heappushpop(self.heap, entry)[1]]


def _findings(most):
    """A function from Arrow batches of (text) to the labelled windows with the smallest hashes, ``most`` of each label."""

    def find(batches):
        import pyarrow as pa

        table, (assign, access) = _tables(), _patterns()
        best = {False: _Smallest(most), True: _Smallest(most)}
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                for t, base, runs in zip(texts, *_find(texts, table, assign, access), strict=True):
                    for start, end, label in _parts(runs, base):
                        if label is not None:
                            apart = _apart(t[start:end])
                            for w in _windows(t, start, end):
                                best[label].add(w, apart)
        for label, own in best.items():
            rows = [{"win": w, "label": label, "hash": -h, "apart": own.held[w]} for h, w in own.heap]
            kinds = [("win", pa.string()), ("label", pa.bool_()), ("hash", pa.int64()), ("apart", pa.bool_())]
            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    return find


def _true_scores(shared):
    """A function from Arrow batches of (text) to the scores of all true findings not trained on, with and without the text around."""

    def score(batches):
        import numpy as np
        import pyarrow as pa

        (net, trained), table, (assign, access) = shared.value, _tables(), _patterns()
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                parts = []
                for i, (base, runs) in enumerate(zip(*_find(texts, table, assign, access), strict=True)):
                    parts += [(i, s, e) for s, e, label in _parts(runs if base else [], base) if label]
                parts = [(i, s, e) for i, s, e in parts if trained.isdisjoint(_windows(texts[i], s, e))]
                if parts:
                    both = np.concatenate([_scores(net, texts, parts, alone) for alone in (False, True)])
                    yield pa.RecordBatch.from_arrays([pa.array(both)], ["score"])

    return score


def fit(df: DataFrame, text: str = "text", findings: int = FINDINGS) -> Network | None:
    """Train on labelled findings of all documents, chosen by a hash; None without both labels in the table."""
    import numpy as np

    bound_batches(df.sparkSession)
    texts = df.select(text)
    found = texts.mapInArrow(tidy(_findings(findings)), "win string, label boolean, hash bigint, apart boolean")
    found = materialize(found, "secret-findings")  # at most 2 * `findings` short strings of a task
    # a window that several tasks found is kept apart if all did so
    found = found.groupBy("win", "label", "hash").agg(F.min("apart").alias("apart"))
    rows = []
    for label in (False, True):  # at most `findings` short strings each
        rows += found.filter(F.col("label") == label).orderBy("hash", "win").limit(findings).collect()
    labels = np.array([r.label for r in rows], float)
    if not 0 < labels.sum() < len(labels):
        return None
    codes = _codes([r.win for r in rows])
    apart = np.array([r.apart for r in rows])
    inner = ~apart
    if not (0 < labels[apart].sum() < apart.sum() and 0 < labels[inner].sum() < inner.sum()):  # too few to keep some apart
        apart[:] = inner[:] = True
        trained = frozenset()
    else:
        trained = frozenset(r.win for r in rows if r.label and not r.apart)
    net = Network.start()
    net.train(codes[inner], labels[inner])
    # recall is to hold with and without the text around
    held = np.concatenate((codes[apart], _alone(codes[apart])))
    net.calibrate(held, np.tile(labels[apart], 2), RECALL)
    shared = df.sparkSession.sparkContext.broadcast((net, trained))
    scores = texts.mapInArrow(tidy(_true_scores(shared)), "score double")
    # without any true finding beyond the training windows, the threshold of those kept apart stays
    cut = scores.agg(F.percentile_approx("score", F.lit(1 - RECALL), F.lit(RANKS))).first()[0]
    net.threshold = net.threshold if cut is None else cut
    return net


def _scores(net, texts, parts, alone=False):
    """The score of each (number of its text, start, end): the largest of its windows, optionally without the text around."""
    from itertools import islice

    import numpy as np

    best = np.zeros(len(parts))
    read = ((k, w) for k, (i, s, e) in enumerate(parts) for w in _windows(texts[i], s, e))
    while held := list(islice(read, BATCH)):
        codes = _codes([w for _, w in held])
        np.maximum.at(best, [k for k, _ in held], net.score(_alone(codes) if alone else codes))
    return best


def _scanner(net):
    table, (assign, access) = _tables(), _patterns()

    def scan(texts):
        out, parts = [], []
        for i, (base, runs) in enumerate(zip(*_find(texts, table, assign, access), strict=True)):
            out.append([(s, k, e, 1.0) for s, k, e in base])
            if net is not None:
                parts += [(i, s, e) for s, e, label in _parts(runs, base) if not label]
        if parts:
            for (i, s, e), p in zip(parts, _scores(net, texts, parts).tolist(), strict=True):
                if p >= net.threshold:
                    out[i].append((s, 3, e, p))
        return [[{"kind": KINDS[k], "start": s, "end": e, "score": p} for s, k, e, p in sorted(spans)] for spans in out]

    return scan


def with_spans(df: DataFrame, net: Network | None, text: str = "text", into: str = "spans") -> DataFrame:
    """``df`` with ``into``: array of struct(kind, start, end, score), by start and then kind; places in code points."""
    shared = df.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        import pyarrow as pa

        scan = _scanner(shared.value)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for texts in batches:
            yield pa.array([x for _, part in chunks(texts) for x in scan(part)], kind)

    return df.withColumn(into, arrow_column(run, f"array<{_SPAN}>", F.col(text)))


def listed(spans: Column, kinds=KINDS) -> Column:
    """kind:start:end of the spans of some kinds, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
