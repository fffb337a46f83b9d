"""Secret scan: base patterns, and a character convolutional network over every further candidate.

Base findings are leftmost, non-overlapping matches per kind over the whole text (offsets in code points,
end exclusive): `assign`, a secret's name with a value of 6 characters or more; `access`, an access-key id of
20 or more; `hex`, 24 or more hex digits. They always stay.

Candidates are all other maximal runs of the characters that values are made of: 16 or more with a digit, or 24
or more. Base spans are taken out of a run first: what they cover is known, and each remaining part that still
meets that rule is a candidate of its own. The network sees a candidate through windows of `INSIDE` characters
every `STEP` characters, the last one at its end, each with its surroundings. It is trained on windows of the
corpus' own labelled findings: values of base findings against candidates outside of them, at most
`per_class` of each, chosen by hash with a partial minimum per task. A third of the values, chosen by hash too,
is held back to calibrate the threshold. Candidates outside of base findings may be secrets too, so windows that
a first fit, on the other half of them, takes for findings are left out of the last one. A candidate's score is that of its best window.
The threshold is as high as possible while at least `recall` of all held-back findings of the corpus are kept;
they are counted by score in `BINS` bins. Windows above it become `net` spans, joined where they
overlap, and widened to whole groups of letters and digits.

Rows: null or empty text has no spans. Texts of any length are scanned whole. Repeated rows get the same answer.
Without any finding in the corpus there is nothing to learn, and base findings are all. An empty
table gives an empty result. Other columns pass through `redact` untouched.
"""

import hashlib
import pickle
import re
import zlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import functions as F

from cutline.llm.common import documents, new_folder, ship, stored

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "net")

NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
BEFORE, INSIDE, AFTER, STEP = 24, 32, 8, 8
BINS = 1 << 16
FOUND = (
    "doc_id long, th long, base string, places array<int>, windows array<binary>, known array<boolean>, held array<boolean>"
)
SCHEMA = "doc_id long, th long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def base_spans(text):
    """(start, kind number, end) of all base findings, in order."""
    found = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidate(run):
    return len(run) >= 24 or len(run) >= 16 and any(c.isdigit() for c in run)


def candidates(text, spans):
    """(start, end, whether base spans cover it) of parts of runs that may be values; spans are sorted by start."""
    covered = []
    for start, _, end in spans:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    ends = [end for _, end in covered]
    for m in CANDIDATE.finditer(text):
        at, last, n = m.start(), m.end(), bisect_right(ends, m.start())
        parts = []
        while n < len(covered) and covered[n][0] < last:
            start, end = max(at, covered[n][0]), min(last, covered[n][1])
            parts += [(at, start, False), (start, end, True)]
            at, n = end, n + 1
        for start, end, known in [*parts, (at, last, False)]:
            if candidate(text[start:end]) or known and end - start >= 16:
                yield start, end, known


def starts(start, end):
    """Where the windows over a candidate start."""
    return [*range(start, end - INSIDE, STEP), max(start, end - INSIDE)]


def window(text, start, end):
    """Symbols of a part and its surroundings: code points up to 254 stand for themselves, others are 255."""
    end = min(end, start + INSIDE)
    parts = (text[max(0, start - BEFORE):start].rjust(BEFORE, "\0"), text[start:end].ljust(INSIDE, "\0"),
             text[end:end + AFTER].ljust(AFTER, "\0"))
    return "".join(parts).translate(_LARGE).encode("latin-1", "replace")


class _Large(dict):
    def __missing__(self, code):
        return code if code < 255 else 255


_LARGE = _Large()


def spans_text(spans):
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs):
    """(doc_id, hash of the text, base spans, places of all candidates; their windows, whether known and held back)."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                base, places, windows, known, held = [], [], [], [], []
                for text in part.column(2).to_pylist():
                    text = text or ""
                    spans = base_spans(text)
                    base.append(spans_text(spans))
                    for column in (places, windows, known, held):
                        column.append([])
                    for a, b, covered in candidates(text, spans):
                        own = [window(text, at, b) for at in starts(a, b)]
                        back = covered and zlib.crc32(text[a:b].encode()) % 3 == 0
                        places[-1] += [a, b]
                        windows[-1] += own
                        known[-1] += [covered] * len(own)
                        held[-1] += [back] * len(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(base, pa.string()), pa.array(places, pa.list_(pa.int32())),
                     pa.array(windows, pa.list_(pa.binary())), pa.array(known, pa.list_(pa.bool_())),
                     pa.array(held, pa.list_(pa.bool_()))],
                    [f.split()[0] for f in FOUND.split(", ")])

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, FOUND)


def scored(part, net, wanted):
    """(row, start, end, scores of the windows) of each candidate of a batch whose first window is wanted(known, held)."""
    import numpy as np

    places, windows, known, held = (part.column(c).to_pylist() for c in range(3, 7))
    runs, symbols = [], []
    for row, own in enumerate(places):
        at = 0
        for a, b in zip(own[::2], own[1::2]):
            n = len(starts(a, b))
            if wanted(known[row][at], held[row][at]):
                runs.append((row, a, b, n, windows[row][at:at + n]))
                symbols += runs[-1][4]
            at += n
    if not runs:
        return
    x = np.frombuffer(b"".join(symbols), np.uint8).reshape(-1, BEFORE + INSIDE + AFTER)
    scores = np.concatenate([net.predict(x[i:i + 4096])[:, 1] for i in range(0, len(x), 4096)])
    at = 0
    for row, a, b, n, own in runs:
        yield row, a, b, own, scores[at:at + n]
        at += n


def calibrate(found, net, recall, held):
    """The highest threshold that keeps `recall` of the corpus' known candidates (of those held back, if `held`)."""
    shared = found.sparkSession.sparkContext.broadcast(pickle.dumps(net))

    def run(batches):
        import numpy as np

        net, counts = pickle.loads(shared.value), np.zeros(BINS + 1, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                for *_, scores in scored(batch.slice(at, 1000), net, lambda known, back: known and (back or not held)):
                    counts[int(scores.max() * BINS)] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bin", "n"])

    rows = found.mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    kept, total = 0, sum(r["n"] for r in rows)
    for r in sorted(rows, key=lambda r: -r["bin"]):
        kept += r["n"]
        if kept >= recall * total:
            return r["bin"] / BINS
    return None


def fit(found, per_class=1500, recall=0.98):
    """A network and its threshold, or None when there are no findings, or nothing else, to learn from."""
    import numpy as np

    from cutline.llm.convnet import ConvNet

    pairs = found.select(F.explode(F.arrays_zip("windows", "known", "held")).alias("x")).select(
        F.col("x.windows").alias("window"), F.col("x.known").alias("known"), F.col("x.held").alias("held"))
    order = F.xxhash64("window")
    rows = pairs.groupBy("known", "held", F.pmod(order, F.lit(per_class)).alias("place")).agg(
        F.min_by("window", F.struct(order, "window")).alias("window")).collect()
    rows = sorted((bytes(r["window"]), r["known"], r["held"]) for r in rows)
    y, held = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))
    if y.sum() < 3 or (1 - y).sum() < 3:
        return None
    # Where too few findings are left to learn from, or none is held back, all are learnt from and calibrated on.
    split = y[held == 0].sum() >= 3 and held.any()
    if split:
        rows, y = [r for r in rows if not r[2]], y[held == 0]
    x = np.array([np.frombuffer(r[0], np.uint8) for r in rows])

    def learn(use):
        parts = [np.flatnonzero(use & (y == c)) for c in (0, 1)]
        size = max(map(len, parts))
        take = np.concatenate([np.resize(part, size) for part in parts])
        return ConvNet(2, widths=(2, 4, 6), seed=23).fit(x[take], y[take], epochs=4)

    half, doubtful = np.array([zlib.crc32(r[0]) % 2 for r in rows]), np.zeros(len(y), bool)
    for n in (0, 1):
        own, other = ((y == 0) & (half == i) for i in (n, 1 - n))
        if own.any() and other.any():
            doubtful[own] = learn((y == 1) | other).predict(x[own])[:, 1] >= 0.5
    net = learn(~doubtful if (~doubtful & (y == 0)).any() else np.ones(len(y), bool))
    return net, calibrate(found, net, recall, bool(split))


def flagged(start, end, windows, scores, threshold):
    """(start, end) of the parts of a candidate that score, widened to whole groups of letters and digits."""
    at, text, out = starts(start, end), bytearray(end - start), []
    for s, w in zip(at, windows):
        inner = w[BEFORE:BEFORE + min(INSIDE, end - s)]
        text[s - start:s - start + len(inner)] = inner
    for s, score in zip(at, scores):
        if score < threshold:
            continue
        a, b = s - start, min(s + INSIDE, end) - start
        while a and text[a - 1:a + 1].isalnum():
            a -= 1
        while b < len(text) and text[b - 1:b + 1].isalnum():
            b += 1
        if out and start + a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], start + b)
        else:
            out.append([start + a, start + b])
    return out


def decide(found, model):
    """One row per document with the base counts and digest, and all spans."""
    shared = found.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches):
        model = pickle.loads(shared.value)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                base = part.column(2).to_pylist()
                spans = [[(int(s), KINDS.index(k), int(e)) for k, s, e in (x.split(":") for x in b.split(",") if x)] for b in base]
                counts = [[sum(kind == k for _, kind, _ in own) for own in spans] for k in range(3)]
                for row, a, b, windows, scores in scored(part, model[0], lambda known, back: not known) if model else ():
                    spans[row] += [(c, 3, d) for c, d in flagged(a, b, windows, scores, model[1])]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                    pa.array([spans_text(sorted(own)) for own in spans], pa.string()),
                ], [f.split()[0] for f in SCHEMA.split(", ")])

    return found.mapInArrow(run, SCHEMA)


def find_secrets(docs):
    """One row per document: doc_id, th (hash of the text), n_assign, n_access, n_hex, base_sha256, spans."""
    found = stored(scan(docs), f"{new_folder(docs.sparkSession, 'secrets')}/found")
    return decide(found, fit(found))


def redact(docs, mark="[secret]"):
    """The rows of `docs` with every span of their text replaced by a mark, overlapping spans by one."""
    spans = find_secrets(docs).filter("spans != ''").select(
        F.col("doc_id").alias("__doc"), F.col("th").alias("__th"), F.col("spans").alias("__spans")).distinct()
    keyed = docs.withColumn("__own", F.xxhash64("text"))
    joined = keyed.join(spans, keyed["doc_id"].eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__th")), "left")
    return joined.drop("__doc", "__th", "__own").mapInArrow(_redactor(docs.columns, mark), docs.schema)


def _redactor(columns, mark):
    place = columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for row, spans in enumerate(batch.column(len(columns)).to_pylist()):
                if spans:
                    texts[row] = blanked(texts[row], spans, mark)
            out = [pa.array(texts, batch.column(place).type) if i == place else batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(out, columns)

    return run


def blanked(text, spans, mark):
    parts, at = [], 0
    for start, end in sorted((int(s), int(e)) for _, s, e in (x.split(":") for x in spans.split(","))):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


def op4_secret_scan(spark, sf_dir):
    return find_secrets(documents(spark, sf_dir)).drop("th")
