"""What the operators of this folder share: scratch tables, ASCII case folding, batches of text bytes."""

import os
import tempfile
import zipfile

from pyspark.sql import functions as F

import cutline
from cutline.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BLANKS = " \t\n\x0b\x0c\r"


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text):
    """Lower-cases A-Z only. Text of ASCII alone takes the short way of `lower`; both give the same."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def stored(df, path):
    """Writes a frame to the shared folder and reads it back: lineage ends here, and any executor can read it."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def new_folder(spark, label):
    return scratch_dir(spark, label)


_shipped = set()


def ship(spark):
    """Makes this package importable in Python workers, once per application, as --py-files would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(cutline.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="cutline-code-"), "cutline.zip")
    with zipfile.ZipFile(path, "w") as out:
        for base, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(base, name)
                    out.write(file, os.path.join("cutline", os.path.relpath(file, root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def text_slices(column, most_bytes=1 << 20):
    """Yields (first, last, bytes, offsets) over an Arrow string column; null counts as empty.

    A slice holds whole texts of about `most_bytes` together, so that arrays with several numbers per
    byte stay small whatever the batch size; one longer text is a slice of its own.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + most_bytes, "right")) - 1)
        last = min(last, len(column))
        yield first, last, data[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


class Recent:
    """A bounded memory of results for strings, in two generations: what was used of late stays.

    `learn(keys)` computes what is missing (compute: list of keys -> list of values) and returns a dict
    that holds a value for each of the keys. `recall(keys)` returns a dict of the keys alone, which is small: quicker to
    look at when each key is needed many times.
    """

    def __init__(self, compute, most=800_000):
        self.compute, self.most, self.now, self.before = compute, most, {}, {}

    def learn(self, keys):
        now = self.now
        keys = keys if isinstance(keys, set) else set(keys)
        new = list(keys.difference(now))
        if new:
            if len(now) + len(new) > self.most // 2 and now:
                self.before, self.now = now, {}
                now, new = self.now, list(keys)
            before = self.before
            missing = [k for k in new if k not in before]
            now.update((k, before[k]) for k in new if k in before)
            if missing:
                now.update(zip(missing, self.compute(missing)))
        return now

    def recall(self, keys):
        found = dict(zip(keys, map(self.now.get, keys)))
        missing = {k for k, v in found.items() if v is None}
        if missing:
            known = self.learn(missing)
            found.update((k, known[k]) for k in missing)
        return found
