"""Token counts (operator 1).

The tokenizer never merges across ASCII white space: its pre-tokenizer drops
white space, and neither its normalizer nor its special strings reach over
it.  A text's count is therefore the sum of the counts of its runs of other
bytes (the pre-tokens here).  Each block of texts is reduced to (document,
pre-token, frequency); pieces are counted once per distinct pre-token of the
block, joined to the frequencies and summed per document.  Ids of the texts
are never materialised, nothing is shuffled, and memory follows the block.
"""

from __future__ import annotations

import os
from collections import defaultdict
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwin.llm.common import batch_of, blocks, utf8

BLOCK_BYTES = 32 << 20
CACHED_PIECES = 400_000      # pre-tokens a task remembers across blocks ...
CACHED_BYTES = 64            # ... of at most so many bytes (scripts without spaces have long ones)


def load_tokenizer(path: str):
    """A tokenizer file, without truncation or padding and on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def piece_counts(tokenizer, pretokens: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """Pieces of each pre-token; ``known`` remembers a bounded number."""
    out = np.fromiter((known.get(w, -1) for w in pretokens), np.int64, len(pretokens))
    new = np.flatnonzero(out < 0)
    for at in range(0, len(new), 20_000):
        part = new[at:at + 20_000]
        texts = [pretokens[i].decode("utf-8", "replace") for i in part]
        out[part] = [len(e.ids) for e in
                     tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    for i in new[:max(0, CACHED_PIECES - len(known))]:
        if len(pretokens[i]) <= CACHED_BYTES:
            known[pretokens[i]] = int(out[i])
    return out


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every text.

    One row per input row (repeated rows stay repeated): ``doc_id, n_bytes,
    n_tokens, over_limit``.  A null or empty text has 0 bytes and 0 tokens; a
    null id stays null; other columns of ``docs`` are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        tok = load_tokenizer(tokenizer_path)
        known: dict[bytes, int] = {}
        for part in blocks(batches, "t", BLOCK_BYTES):
            texts = utf8(part, "t")
            number = defaultdict(count().__next__)
            docs_at, ids_at, freq_at = [], [], []
            for d, text in enumerate(texts):
                runs = text.split() if text else ()
                ids, freq = np.unique(np.fromiter(map(number.__getitem__, runs), np.int64,
                                                  len(runs)), return_counts=True)
                docs_at.append(np.full(len(ids), d))
                ids_at.append(ids)
                freq_at.append(freq)
            pieces = piece_counts(tok, list(number), known)
            n = np.zeros(len(texts), np.int64)
            if len(pieces):
                np.add.at(n, np.concatenate(docs_at),
                          pieces[np.concatenate(ids_at)] * np.concatenate(freq_at))
            yield batch_of(arrow, part.column("d"), [len(t) if t else 0 for t in texts],
                           n, n > limit)

    return docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t")
                       ).mapInArrow(run, schema)
