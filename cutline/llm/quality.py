"""Quality classifier: weak labels from overlapping heuristics, and a hashed linear scorer trained on them.

1. Eight overlapping heuristic labellers read each whole text and vote good, bad or undecided; one that a text gives
   no evidence (too few words or lines for it) has no vote, and says nothing about the text.
2. Expectation-maximisation estimates from the votes of all documents how often each labeller votes what on
   good and on bad documents, and how frequent good ones are. A prior of `PRIOR` documents a class keeps the classes what
   they are named and rules no vote out; its weight fades as documents come in. It runs on the number of documents per vote pattern, of which there
   are at most 4 ** 8 whatever the size of the corpus. No true label is used.
3. The posterior of each pattern labels a bounded sample of pieces (at most `per_pattern` of `PIECE` bytes for
   each pattern, chosen by hash), weighted by the pattern's documents. They train a linear scorer over
   hashed byte n-grams and the labellers' measures in steps.
4. Every whole text is scored. The mean weight of n-grams is shrunk by `SHRINK` n-grams, so that a few words
   alone do not condemn a text. The threshold keeps at least `keep` of the posterior weight of good
   documents, and is `most` at most: rejection is for clear cases, clean text stays. That weight is summed
   over the scores of all whole texts of the corpus, in steps of 1 / 64 of the odds' logarithm.

Rows: null text, and text without words, has score 0 and is rejected. Repeated rows get the same answer. An
empty table gives an empty result. The id and other columns are no inputs.
"""

import pickle

import pyarrow as pa
from pyspark.sql import functions as F

from cutline.llm.common import documents, ship, text_slices

LABELLERS = ("symbols", "capitals", "trigrams", "doubled", "letters", "lone_signs", "lines", "lengths")
LONGEST = 30  # letters in a word, for the measure of lengths
PRIOR = 20
PIECE, BUCKETS, SIZES, STEPS, SHRINK = 1500, 1 << 18, (1, 3, 4), 12, 60
GOOD, BAD, NONE, MISSING = 1, 0, 2, 3
PLACES = 4  # kinds of votes, the base of a pattern's number


def features(data, offsets):
    """The measures that the labellers look at, one row per text; NaN where a text gives no evidence."""
    import numpy as np

    from cutline.llm.shingles import word_hashes

    texts = len(offsets) - 1
    kind = np.zeros(256, np.int8)
    kind[[ord(c) for c in "#$%&*!|{}<>=@~^\\"]] = 1
    kind[65:91], kind[97:123] = 2, 3
    kind[128:] = 4
    kinds = kind[data]

    def total(mask):
        return np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])

    bytes_, symbols, upper, lower = np.diff(offsets), total(kinds == 1), total(kinds == 2), total(kinds == 3)
    words, at = word_hashes(data, offsets)
    counts = np.diff(at)
    letters = np.concatenate(([0], np.cumsum(kinds >= 2)))
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(~blank & (edge[:-1] | np.concatenate(([True], blank[:-1]))))
    ends = np.flatnonzero(~blank & (edge[1:] | np.concatenate((blank[1:], [True])))) + 1
    lone = np.concatenate(([0], np.cumsum(letters[ends] == letters[starts])))
    same = np.concatenate(([0, 0], np.cumsum(words[1:] == words[:-1])))[:len(words) + 1]
    triples = words[2:] + words[1:-1] * np.uint64(3) + words[:-2] * np.uint64(7) if len(words) > 2 else words[:0]
    out = np.full((texts, len(LABELLERS)), np.nan)
    with np.errstate(invalid="ignore", divide="ignore"):
        out[:, 0] = symbols / bytes_
        out[:, 1] = np.where(upper + lower >= 8, upper / (upper + lower), np.nan)
        out[:, 3] = np.where(counts >= 6, (same[at[1:]] - same[np.minimum(at[:-1] + 1, len(same) - 1)]) / (counts - 1), np.nan)
        out[:, 4] = np.where(counts >= 10, total(kinds >= 2) / (bytes_ - total(blank)), np.nan)
        out[:, 5] = np.where(counts >= 10, np.diff(lone[at]) / counts, np.nan)
    for row in np.flatnonzero(counts >= 10):
        own = triples[at[row]:at[row + 1] - 2]
        out[row, 2] = len(np.unique(own)) / len(own)
        lines = data[offsets[row]:offsets[row + 1]].tobytes().split(b"\n")
        if len(lines) >= 4:
            out[row, 6] = len(set(lines)) / len(lines)
    with np.errstate(invalid="ignore", divide="ignore"):
        out[:, 7] = np.where(counts >= 10, np.minimum(total(kinds >= 2) / np.maximum(counts, 1) / LONGEST, 1), np.nan)
    return out, counts


def votes(measures):
    """GOOD, BAD, NONE (undecided) or MISSING (no evidence) per text and labeller."""
    import numpy as np

    symbols, capitals, trigrams, doubled, letters, lone, lines, lengths = measures.T
    never = np.zeros(len(measures), bool)
    with np.errstate(invalid="ignore"):
        rules = [
            (symbols > 0.05, never), (capitals > 0.4, never), (trigrams < 0.7, never), (doubled > 0.25, never),
            (letters < 0.75, letters > 0.93), (lone > 0.15, never), (lines < 0.6, never),
            (lengths < 1 / LONGEST, (lengths > 2.5 / LONGEST) & (lengths < 12 / LONGEST)),
        ]
    cast = np.stack([np.where(bad, BAD, np.where(good, GOOD, NONE)) for bad, good in rules], 1)
    return np.where(np.isnan(measures), MISSING, cast)


def pattern_numbers(measures):
    import numpy as np

    return votes(measures) @ (PLACES ** np.arange(len(LABELLERS)))


def estimate(patterns, counts, rounds=500, prior=PRIOR):
    """(posterior of good per pattern, vote probabilities by class, share of good) by expectation-maximisation.

    The prior counts as `prior` documents a class, whatever the number of documents. Rounds end when nothing moves any more.
    """
    import numpy as np

    labellers = patterns.shape[1]
    start = np.tile(np.array([[0.4, 0.2, 0.4], [0.01, 0.49, 0.5]]).T[None], (labellers, 1, 1))  # vote, class bad/good
    odds, share = start.copy(), 0.7
    for _ in range(rounds):
        known = np.concatenate((np.log(odds), np.zeros((labellers, 1, 2))), 1)  # a missing vote tells nothing
        log = np.log([1 - share, share]) + sum(known[i][patterns[:, i]] for i in range(labellers))
        log -= log.max(1, keepdims=True)
        post = np.exp(log)
        post /= post.sum(1, keepdims=True)
        weight = post * counts[:, None]
        before, share = share, float(np.clip((weight[:, 1].sum() + 0.7 * prior) / (weight.sum() + prior), 0.01, 0.99))
        moved = abs(share - before)
        for i in range(labellers):
            tally = np.stack([weight[patterns[:, i] == v].sum(0) for v in range(3)]) + prior * start[i]
            new = tally / tally.sum(0)
            moved = max(moved, float(np.abs(new - odds[i]).max()))
            odds[i] = new
        if moved < 1e-9:
            break
    return post[:, 1], odds, share


def hashed(data):
    """Bucket of the n-gram that starts at each byte, for each size: an array per size."""
    import numpy as np

    out = []
    for size in SIZES:
        code = np.zeros(max(0, len(data) - size + 1), np.uint32)
        for j in range(size):
            code = code * np.uint32(0x01000193) + data[j:j + len(code)] + np.uint32(size)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        out.append((code >> np.uint32(14)) & np.uint32(BUCKETS - 1))
    return out


def stepped(measures):
    """Positions of the labellers' measures, in steps, behind the n-gram buckets; -1 where there is none."""
    import numpy as np

    step = np.clip(np.nan_to_num(measures, nan=-1) * (STEPS - 1), -1, STEPS - 1).astype(np.int64)
    place = BUCKETS + np.arange(measures.shape[1]) * STEPS + step
    return np.where(np.isnan(measures), -1, np.maximum(place, BUCKETS))


def train(pieces, labels, weights, share, epochs=30, rate=20.0, seed=5):
    """Weights of the scorer and its bias; logistic loss, soft labels, both classes with the same total weight."""
    import numpy as np

    w, bias = np.zeros(BUCKETS + len(LABELLERS) * STEPS, np.float32), float(np.log(share / (1 - share)))
    data = [np.frombuffer(p, np.uint8) for p in pieces]
    rows = [np.concatenate(hashed(d)) for d in data]
    steps = [stepped(features(d, np.array([0, len(d)]))[0])[0] for d in data]
    rng = np.random.default_rng(seed)
    good, bad = (weights * labels).sum(), (weights * (1 - labels)).sum()
    pull = np.minimum(np.sqrt(weights / weights.mean()), 3) * np.where(labels > 0.5, min(1, bad / good + 0.3), 1)
    for epoch in range(epochs):
        for i in rng.permutation(len(rows)):
            size, own = len(rows[i]) + SHRINK, steps[i][steps[i] >= 0]
            p = 1 / (1 + np.exp(-np.clip(w[rows[i]].sum() / size * 10 + w[own].sum() + bias, -30, 30)))
            error = float(pull[i] * (labels[i] - p)) / (1 + epoch / 3)
            np.add.at(w, rows[i], np.float32(rate * error / size))
            w[own] += 0.05 * error
    return w, bias


def score_slice(w, bias, data, offsets, measured=None):
    """Probability of good for each text of a slice; 0 for texts without words. `measured`: their features, if known."""
    import numpy as np

    measures, words = measured or features(data, offsets)
    sums, counts = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
    for size, codes in zip(SIZES, hashed(data)):
        run = np.concatenate(([0.0], np.cumsum(w[codes], dtype=np.float64)))
        first = np.minimum(offsets[:-1], len(codes))
        last = np.clip(offsets[1:] - size + 1, first, len(codes))
        sums += run[last] - run[first]
        counts += last - first
    places = stepped(measures)
    extra = np.where(places >= 0, w[np.maximum(places, 0)], 0).sum(1)
    odds = sums / (counts + SHRINK) * 10 + extra + bias
    return np.where(words > 0, 1 / (1 + np.exp(-np.clip(odds, -30, 30))), 0.0)


def _patterns(docs, per_pattern):
    """(pattern, documents, pieces) over all documents: at most 4 ** 8 patterns of at most per_pattern pieces."""
    ship(docs.sparkSession)

    def run(batches):
        import numpy as np

        for batch in batches:
            order = batch.column(1).to_numpy()
            for first, last, data, offsets in text_slices(batch.column(0)):
                measures, counts = features(data, offsets)
                codes = pattern_numbers(measures)
                size = np.diff(offsets)
                start = offsets[:-1] + order[first:last] % np.maximum(size - PIECE + 1, 1)
                pieces = [data[a:min(a + PIECE, b)].tobytes() for a, b in zip(start, offsets[1:])]
                keep = counts > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes[keep]), pa.array(order[first:last][keep]), pa.array(pieces, pa.binary()).filter(pa.array(keep))],
                    ["pattern", "h", "piece"])

    order = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)).alias("h")
    rows = docs.select("text", order).mapInArrow(run, "pattern long, h long, piece binary")
    return rows.groupBy("pattern", (F.col("h") % per_pattern).alias("place")).agg(
        F.count(F.lit(1)).alias("documents"), F.min_by("piece", "h").alias("piece"))


def edges():
    """The lower edges of the score bins."""
    import numpy as np

    return np.concatenate(([0.0], 1 / (1 + np.exp(-np.arange(-30, 30, 1 / 64)))))


def totals(docs, w, bias, posterior):
    """Posterior weight of good, in units of 2 ** -20, by score bin over all whole texts with words.

    `posterior` maps vote patterns to weights. Whole units make the sums independent of their order.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps((w, bias, posterior)))

    def run(batches):
        import numpy as np

        w, bias, posterior = pickle.loads(shared.value)
        units = np.zeros(PLACES ** len(LABELLERS), np.int64)
        units[list(posterior)] = np.rint(np.array(list(posterior.values())) * (1 << 20))
        bins = edges()
        sums = np.zeros(len(bins), np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                measures, counts = features(data, offsets)
                own = units[pattern_numbers(measures)][counts > 0]
                scores = score_slice(w, bias, data, offsets, (measures, counts))[counts > 0]
                np.add.at(sums, np.searchsorted(bins, scores, "right") - 1, own)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["bin", "weight"])

    rows = docs.select("text").mapInArrow(run, "bin long, weight long")
    return {r["bin"]: r["weight"] for r in rows.groupBy("bin").agg(F.sum("weight").alias("weight")).collect()}


def threshold_of(weights, keep, most):
    """The highest lower edge of a bin that keeps at least `keep` of the weight, `most` at most."""
    bins, total, lost = edges(), sum(weights.values()), 0
    for at in sorted(weights):
        lost += weights[at]
        if lost > (1 - keep) * total:
            return min(most, float(bins[at]))
    return most


def fit(docs, per_pattern=64, keep=0.999, most=0.35):
    """A dict with the scorer's weights, its threshold, and the labellers' estimated accuracies; None without words."""
    import numpy as np

    rows = _patterns(docs, per_pattern).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["pattern"], r["place"]))
    codes, at = np.unique([r["pattern"] for r in rows], return_inverse=True)
    documents_ = np.array([r["documents"] for r in rows], float)
    patterns = codes[:, None] // PLACES ** np.arange(len(LABELLERS)) % PLACES
    posterior, odds, share = estimate(patterns, np.bincount(at, documents_))
    labels, pieces = posterior[at], [bytes(r["piece"]) for r in rows]
    w, bias = train(pieces, labels, documents_, share)
    weights = totals(docs, w, bias, dict(zip(codes.tolist(), posterior.tolist()))) if (labels > 0.5).any() else {}
    threshold = threshold_of(weights, keep, most)
    good = {name: odds[i] for i, name in enumerate(LABELLERS)}
    return {"weights": w, "bias": bias, "threshold": threshold, "share": share, "labellers": good}


def judge(docs, model):
    """The rows of `docs` with quality_score and accepted added (replacing columns of these names)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    own = [c for c in docs.columns if c not in ("quality_score", "accepted")]
    schema = docs.select(*own, F.lit(0.0).alias("quality_score"), F.lit(True).alias("accepted")).schema
    place = own.index("text")

    def run(batches):
        import numpy as np

        model = pickle.loads(shared.value)
        for batch in batches:
            score = np.zeros(len(batch))
            for first, last, data, offsets in text_slices(batch.column(place)) if model else ():
                score[first:last] = score_slice(model["weights"], model["bias"], data, offsets)
            least = model["threshold"] if model else 1.0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= least) & (score > 0))], schema.names)

    return docs.select(*own).mapInArrow(run, schema)


def classify(docs):
    return judge(docs, fit(docs.select("text")))


def op7_quality_classifier(spark, sf_dir):
    return classify(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "quality_score", "accepted")
