"""Periodic runs of words, found through string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are identical) of at least max(LEAST, POWER * q)
words that no neighbouring word extends. All runs of a text are found, by scales t = 2, 4, 8, ...:

1. Every place has a hash of its next t words; the hash of 2t words comes from two of t. A place whose next t words
   have a period of at most t / 3 has no number at scale t.
2. A place is in the synchronising set of t if the least number among it and the t places behind it stands at one
   of the two ends. Equal stretches of 2t words thus agree on their places in the set, and wherever 3t - 1 words have
   no period of t / 3 or less, one of t neighbouring places is in the set.
3. Hence a run of period p, 3t <= p < 6t, holds two places of the set, p apart, with equal contexts of 2t words.
   Such pairs propose p. Places p apart within 6t and with equal contexts are at most 18 per place.
4. Hashes of 2t words and less discard proposals whose equal stretch is too short; the others are extended
   word by word on the words' own numbers, which makes them exact. Of equal stretches the smallest period stays.
5. Highly periodic regions have no place in any set. Periods up to LEAST / POWER (at least 5) are therefore found by themselves, by
   comparing every word with the one q places on; they also say which places have no number at the next scales.

The work for n words is n log n per scale and log n scales; a scale sees only texts long enough for its periods. Many
texts are worked on at once, with a number of its own between them that no run can hold.

Rows: null and empty texts have no words and no runs; their collapsed text is empty. A text is worked on whole; a very
long one takes about 200 bytes of memory a word. Repeated rows give repeated results; a null doc_id stays null; an
empty table gives an empty one. Other columns are ignored.
"""

import pyarrow as pa
from pyspark.sql import functions as F

from cutline.llm.common import documents, ship

LEAST, POWER = 24, 3
BLANKS = r"[\x20\x09-\x0D]+"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
    "strongest struct<start:long,length:long,period:long>, collapsed string"
)


def _stretches(same, least):
    """(first, behind) of each maximal stretch of true values of at least that length."""
    import numpy as np

    edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).view(np.int8)))
    first, behind = edges[::2], edges[1::2]
    long_enough = behind - first >= least
    return first[long_enough], behind[long_enough]


def _hashed(left, right):
    import numpy as np

    mixed = (left * np.uint64(0x9E3779B97F4A7C15) + right) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def _covered(regions, scale, size):
    """Places whose next `scale` words lie in a region of a period of at most scale / 3."""
    import numpy as np

    first, behind, period = np.array(regions, np.int64).reshape(-1, 3).T
    fits = (3 * period <= scale) & (behind - first >= scale) & (first < size)
    step = np.bincount(first[fits], minlength=size + 1)
    step -= np.bincount(np.minimum(behind[fits] - scale + 1, size), minlength=size + 1)
    return np.cumsum(step[:-1]) > 0


def _synchronising(numbers, none, scale):
    """Places of the synchronising set of a scale; `none` marks places without a number."""
    import numpy as np

    highest = np.uint64(0xFFFFFFFFFFFFFFFF)
    numbers = np.where(none, highest, numbers) if none.any() else numbers
    if len(numbers) <= scale:
        return np.zeros(0, np.int64)
    least, width = numbers, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    ends = np.minimum(numbers[:-scale], numbers[scale:])
    least = np.minimum(least[:len(ends)], ends)
    return np.flatnonzero((least == ends) & (least != highest))


def _proposals(places, contexts, scale):
    """(place, distance) of pairs of places with equal contexts, 3 to 6 scales apart."""
    import numpy as np

    order = np.argsort(contexts, kind="stable")
    places, contexts = places[order], contexts[order]
    found, step = [], 1
    while step < len(places):
        apart = places[step:] - places[:-step]
        near = np.flatnonzero((contexts[step:] == contexts[:-step]) & (apart < 6 * scale))
        if not len(near):
            break
        far = near[apart[near] >= 3 * scale]
        found.append(np.stack((places[far], apart[far])))
        step += 1
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def _plausible(levels, places, apart):
    """Which proposals may have 2 distances of equal places around them, by the hashes of some widths.

    `levels` holds (width, hashes), the widest first. A stretch is known up to the smallest width at each end.
    """
    import numpy as np

    right, left = places.copy(), places.copy()
    for n, (width, hashes) in enumerate(levels):
        last = len(hashes) - 1
        for sign, at in ((1, right), (-1, left)):
            live = np.arange(len(places))
            while len(live):
                probe = at[live] if sign > 0 else at[live] - width
                inside = (probe >= 0) & (probe + apart[live] <= last)
                live, probe = live[inside], probe[inside]
                equal = hashes[probe] == hashes[probe + apart[live]]
                live = live[equal]
                at[live] += sign * width
                if n:
                    break
                live = live[np.abs(at[live] - places[live]) < 2 * apart[live]]
    return right - left + 2 * levels[-1][0] >= 2 * apart


def _equal_from(words, a, b):
    """How many words agree from two places on, the second behind the first."""
    count, width = 0, 64
    while b + count < len(words):
        same = words[a + count:a + count + width][:len(words) - b - count] == words[b + count:b + count + width]
        if not same.all():
            return count + int(same.argmin())
        count, width = count + len(same), width * 2
    return count


def _extended(words, place, period):
    """The whole stretch around a place in which words `period` apart agree, as (first, behind) of its words."""
    behind = place + _equal_from(words, place, place + period) + period
    turned = words[::-1]
    at = len(words) - place - period
    return place - _equal_from(turned, at, at + period), behind


def find_runs(words, sizes, least=LEAST, power=POWER):
    """Runs (first, behind, period), by first and period, of texts whose word numbers follow each other, longest text first.

    `words` holds a number that occurs nowhere else behind each text; `sizes` are the texts' numbers of words.
    """
    import numpy as np

    if power < 3 or least < 1:
        raise ValueError("runs need a power of at least 3")
    small = max(least // power, 5)  # the first scale, 2, proposes periods of 6 and more
    ends = np.cumsum(np.asarray(sizes, np.int64) + 1)
    regions, periods = [], {}
    for period in range(1, small + 1):
        scale = 2
        while scale < 3 * period:
            scale *= 2
        same = words[:-period] == words[period:]
        for first, behind in zip(*(x.tolist() for x in _stretches(same, max(min(least, scale) - period, 1)))):
            behind += period
            regions.append((first, behind, period))
            if behind - first >= max(least, power * period):
                periods.setdefault((first, behind), period)
    levels, scale = [(1, _hashed(words.astype(np.uint64), np.uint64(1)))], 1
    while True:
        # Twice the scale: contexts come from the next level, so it is made first.
        shorter = int(np.searchsorted(-np.asarray(sizes), -9 * scale, "right")) if scale > 1 else len(sizes)
        if not shorter:
            break
        size = int(ends[shorter - 1])
        levels = [(w, h[:max(size - w + 1, 0)]) for w, h in levels]
        width, hashes = levels[0]
        if len(hashes) <= width:
            break
        levels = [(2 * width, _hashed(hashes[:-width], hashes[width:])), *levels][:4]
        if scale > 1:
            numbers, contexts = levels[1][1], levels[0][1]
            places = _synchronising(numbers, _covered(regions, scale, len(numbers)), scale)
            places = places[places < len(contexts)]
            start, apart = _proposals(places, contexts[places], scale)
            large = apart > small
            start, apart = start[large], apart[large]
            kept = _plausible(levels, start, apart)
            order = np.lexsort((start[kept], apart[kept]))
            for first, behind, period in _verified(words[:size], start[kept][order], apart[kept][order], least, power):
                regions.append((first, behind, period))
                periods[first, behind] = min(period, periods.get((first, behind), period))
        scale *= 2
    return sorted((first, behind, period) for (first, behind), period in periods.items())


def _verified(words, places, periods, least, power):
    """Exact runs of proposals sorted by period and place; proposals inside one already extended are passed over."""
    import numpy as np

    n = 0
    while n < len(places):
        period = int(periods[n])
        first, behind = _extended(words, int(places[n]), period)
        if behind - first >= max(least, power * period):
            yield first, behind, period
        group = int(np.searchsorted(periods, period, "right"))
        n += max(1, int(np.searchsorted(places[n:group], behind - period, "left")))


def runs_of_texts(texts, least=LEAST, power=POWER):
    """Words and runs (start, length, period) of each text, given as UTF-8 bytes."""
    import numpy as np

    split = [text.split() for text in texts]  # bytes are split at ASCII blanks only
    order = sorted(range(len(split)), key=lambda n: -len(split[n]))
    known, numbers = {}, []
    for n in order:
        numbers += [known.setdefault(word, len(known)) for word in split[n]]
        numbers.append(-1)
    words = np.array(numbers, np.int64)
    between = np.flatnonzero(words < 0)
    words[between] = len(known) + np.arange(len(between))
    sizes = [len(split[n]) for n in order]
    starts = np.cumsum([0, *(s + 1 for s in sizes)])
    found = [[] for _ in split]
    for first, behind, period in find_runs(words, sizes, least, power) if len(words) > 1 else ():
        at = int(np.searchsorted(starts, first, "right")) - 1
        found[order[at]].append((first - int(starts[at]), behind - first, period))
    return split, found


def collapsed(words, runs):
    """The words without those that a run holds behind its first period."""
    if not runs:
        return words
    dropped = bytearray(len(words))
    for start, length, period in runs:
        dropped[start + period:start + length] = b"\x01" * (length - period)
    return [word for word, gone in zip(words, dropped) if not gone]


def strongest(runs):
    """The run of the greatest exact length / period; of equals that with the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(docs, least=LEAST, power=POWER, slice_bytes=1 << 20):
    """One row per row of `docs`: doc_id, n_words, runs by start and period, the strongest run, the collapsed text."""
    ship(docs.sparkSession)

    def rows(ids, texts):
        split, found = runs_of_texts(texts, least, power)
        for doc_id, words, runs in zip(ids, split, found):
            best = strongest(runs)
            named = [{"start": a, "length": b, "period": c} for a, b, c in runs]
            top = best and {"start": best[0], "length": best[1], "period": best[2]}
            yield doc_id, len(words), named, top, b" ".join(collapsed(words, runs))

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts, first, size = batch.column(1).cast(pa.large_binary()), 0, 0
            values = []
            for n in range(len(batch)):
                values.append(texts[n].as_py() or b"")
                size += len(values[-1])
                if size >= slice_bytes or n == len(batch) - 1:
                    columns = list(zip(*rows(ids[first:n + 1], values)))
                    kinds = (pa.int64(), pa.int64(), pa.list_(RUN), RUN, pa.binary())
                    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                    arrays[4] = arrays[4].cast(pa.string())
                    yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "runs", "strongest", "collapsed"])
                    first, size, values = n + 1, 0, []

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def with_repeats(docs):
    """A tenth of the documents, by the checksum h of their id, with words that repeat from a place on.

    With n words, g = h / 10, a = g % n and p = 1 + (n - a) / (3 + g % 8), word i >= a becomes word a + (i - a) % p.
    Their words are joined by single spaces. Rows without an id are left alone.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", BLANKS), "")))
    placed = chosen.withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)}).withColumn(
        "a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    rest = F.col("n") - F.col("a")
    sized = placed.withColumns({
        "rest": rest, "p": (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int")})
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil(F.col("rest") / F.col("p")).cast("int")
    repeated = F.concat(
        F.slice("words", F.lit(1), F.col("a")), F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), F.col("rest")))
    return sized.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs(with_repeats(documents(spark, sf_dir)))
    run = F.col("strongest")
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        run["start"].alias("start"), run["length"].alias("length"), run["period"].alias("period"),
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
