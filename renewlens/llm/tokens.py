"""Public tokenisers inside tasks.

``vocabulary`` names a file of the installed ``public_tokenizers`` package, or
is a path; it is resolved where the task runs and loaded once a process. A
``.json`` file is read by ``tokenizers``; its ``.tiktoken`` twin holds the same
vocabulary as ranks, gives the same ids (tests compare them) and is about four
times as fast, so it is what the operators load by default. ``documents`` gives
the ids that ``tokenizers`` gives by default: the string of a special token in a
text is that token. ``encoder`` alone takes such strings for ordinary text, as
the measures of quality rules should.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BPE = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
#: The special tokens of the .json file, which its twin lacks.
SPECIAL = {BPE: {"<|endoftext|>": 50256}}


def locate(vocabulary: str) -> str:
    if os.sep in vocabulary:
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


@lru_cache(maxsize=4)
def encoder(vocabulary: str = BPE, special: bool = False):
    """A function from a list of texts to a list of id lists; with ``special``,
    strings of special tokens are these tokens."""
    path = locate(vocabulary)
    if path.endswith(".json"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = not special
        return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    if path.endswith(".model"):
        import sentencepiece

        s = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: s.encode(texts, num_threads=1)
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    e = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL.get(os.path.basename(path), {}))
    if special and e.special_tokens_set:
        return lambda texts: [e.encode(x, allowed_special="all") for x in texts]
    return lambda texts: [e.encode_ordinary(x) for x in texts]


@lru_cache(maxsize=4)
def byte_pieces(vocabulary: str = PIECES) -> frozenset[int]:
    """Ids of the pieces that stand for one raw byte."""
    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_file=locate(vocabulary))
    return frozenset(i for i in range(s.get_piece_size()) if s.is_byte(i))


def documents(batches: Iterator[pa.RecordBatch], vocabulary: str = BPE, end: int | None = 0, rows: int = 128) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches with each row's ids (a null text is empty),
    followed by ``end`` if given."""
    encode = encoder(vocabulary, True)
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            part = batch.slice(lo, rows)
            texts = [x or "" for x in part.column("text").to_pylist()]
            tail = [] if end is None else [end]
            yield part, [np.array(ids + tail, dtype=np.uint32) for ids in encode(texts)]
