"""Ids of a `tokenizers` byte-level BPE through the rank library (tiktoken), where both are known to agree.

`tokenizers` joins the listed pair of the lowest id; the rank library joins the neighbours whose bytes together are
the token of the lowest id, listed or not. What it does within the bytes of a token that it makes depends on these bytes
alone: a join across their edge would have kept the token from being made. So if every token, made from its own bytes,
comes out of its listed pair, all joins are listed ones, in the same order, and the ids agree on every text. `ranks_of` checks
that for each token, so another vocabulary may turn out not to fit; its tokenizer is used as it is.

A suffix that marks the end of a word is a space behind the word: its tokens of one byte have ids below all joins, so the
space is joined to the last byte before anything else.
"""


def ranks_of(spec):
    """Token bytes -> id of a tokenizer file's text, or None where ids by rank might differ from the tokenizer's."""
    import json

    from cutline.llm.byte_bpe import byte_characters

    parts = json.loads(spec)
    model = parts["model"]
    if model.get("type") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
        return None
    suffix, own = model.get("end_of_word_suffix") or "", {c: bytes([b]) for b, c in enumerate(byte_characters())}

    def raw(token):
        end = suffix and token.endswith(suffix)
        return b"".join([own[c] for c in (token[:-len(suffix)] if end else token)]) + (b" " if end else b"")

    added = {t["content"] for t in parts["added_tokens"]}
    vocab = {t: i for t, i in model["vocab"].items() if t not in added}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    try:
        ranks = {raw(t): i for t, i in vocab.items()}
        pairs = {raw(a + b): (raw(a), raw(b)) for a, b in merges}
        order = [vocab[a + b] for a, b in merges]
    except KeyError:  # a character that stands for no byte, or a pair that makes no token
        return None
    base = {bytes([b]) + end for b in range(256) for end in ([b"", b" "] if suffix else [b""])}
    ascending = all(a < b for a, b in zip(order, order[1:])) and max(map(ranks.get, base), default=0) < min(order, default=1 << 40) \
        if base <= ranks.keys() else False
    if not ascending or len(ranks) != len(vocab) or ranks.keys() != base | pairs.keys() or base & pairs.keys():
        return None
    return ranks if all(_last_pair(t, ranks) == pair for t, pair in pairs.items()) else None


def _last_pair(token, ranks):
    """The neighbours whose join makes the token out of its bytes, or None if it is not made."""
    parts, last = [token[n:n + 1] for n in range(len(token))], None
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 40), n) for n, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 40:
            return None
        last = parts[at], parts[at + 1]
        parts[at:at + 2] = [last[0] + last[1]]
    return last


def encoding_of(ranks, pattern, special):
    """text -> array of ids: each match of the pattern is encoded by itself, what lies between is left out.

    `special` (string -> id) are strings that no text holds: with them, ids come as a buffer and not as a list.
    """
    import numpy as np
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    if not special:
        return lambda text: np.array(encoding.encode_ordinary(text), np.uint32)
    return lambda text: encoding.encode_to_numpy(text, disallowed_special=())
