"""Token counts per section of a document, by joining token spans with section spans.

A document is encoded once, whole, so tokens are those that a model would see. Token spans and section
spans are intervals over the same text; both are sorted, so the interval join of one document is two
binary searches per section. It runs within the document: no token row leaves the task.

A token that crosses a section boundary is allocated by one of two rules, and both counts are returned:
`n_tokens` gives it to the section that holds its first character, `token_share` divides it over the
sections in proportion to its bytes in each. Sections that cover the text without overlap sum to the
number of the document's tokens under either rule.

Rows: null or empty text has one empty section without tokens. Texts of any length are encoded whole.
Repeated rows repeat their sections. An empty table gives an empty result. Other columns are ignored.
"""

import pyarrow as pa

from cutline.llm.byte_bpe import read_ranks
from cutline.llm.common import documents, ship

SCHEMA = "doc_id long, section long, char_start long, char_end long, n_tokens long, token_share double"


def line_sections(text):
    """Start and end of each line in code points; a line feed belongs to the line that it ends."""
    edges, at = [0], text.find("\n")
    while at >= 0:
        edges.append(at + 1)
        at = text.find("\n", at + 1)
    if len(edges) == 1 or edges[-1] < len(text):
        edges.append(len(text))
    return list(zip(edges, edges[1:]))


class Counter:
    """Counts the tokens of sections with one encoding."""

    def __init__(self, ranks, pattern):
        import numpy as np
        import tiktoken

        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks={t: r for r, t in ranks.items()}, special_tokens={}
        )
        self.lengths = np.zeros(max(ranks) + 1, np.int64)
        for rank, token in ranks.items():
            self.lengths[rank] = len(token)

    def count(self, text, sections):
        """(tokens by first character, tokens by share) of each (start, end) in code points."""
        import numpy as np

        ids = np.array(self.encoding.encode_ordinary(text), np.int64)
        bounds = np.concatenate(([0], np.cumsum(self.lengths[ids])))
        edges = np.array(sections, np.int64).reshape(-1, 2)
        if bounds[-1] != len(text):
            raw = np.frombuffer(text.encode(), np.uint8)
            edges = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))[edges]
        first = np.searchsorted(bounds[:-1], edges)
        share = np.interp(edges, bounds, np.arange(len(bounds)))
        return first[:, 1] - first[:, 0], share[:, 1] - share[:, 0]


_counters = {}


def token_counts(docs, ranks_path, pattern, sections_of=line_sections):
    """One row per document and section: its span in code points and both token counts."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches):
        import numpy as np

        key = (ranks_path, pattern)
        if key not in _counters:
            _counters[key] = Counter(shared.value, pattern)
        counter = _counters[key]
        for batch in batches:
            for at in range(0, len(batch), 500):
                ids, texts = (c.to_pylist() for c in batch.slice(at, 500).columns)
                spans = [sections_of(text or "") for text in texts]
                counts = [counter.count(text or "", s) for text, s in zip(texts, spans)]
                sizes = [len(s) for s in spans]
                flat = np.array([x for s in spans for x in s], np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array([i for i, n in zip(ids, sizes) for _ in range(n)], pa.int64()),
                    pa.array(np.concatenate([np.arange(n) for n in sizes])),
                    pa.array(flat[:, 0]), pa.array(flat[:, 1]),
                    pa.array(np.concatenate([c[0] for c in counts]).astype(np.int64)),
                    pa.array(np.concatenate([c[1] for c in counts]).astype(np.float64)),
                ], ["doc_id", "section", "char_start", "char_end", "n_tokens", "token_share"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op5_token_counts(spark, sf_dir):
    import public_tokenizers

    docs = documents(spark, sf_dir)
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
