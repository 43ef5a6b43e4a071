"""Token counts of unigram segmentation by dynamic programming over a shared trie.

The distinct pre-tokens of a block of texts form a trie. A prefix's best score and
its token count depend on the prefix alone, so walking the pre-tokens in sorted order
with a stack computes each shared prefix once; the counts at the ends are stored per
pre-token and added up per document.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeframe.llm.suite import query, table
from wakeframe.llm.words import blocks, texts_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
START = "▁"  # marks a word's begin in the vocabulary
BLOCK = 4 << 20  # bytes of text per trie
REMEMBERED = 300_000  # pre-tokens whose counts a task keeps between blocks; the rest are counted again

_END = ""  # where a suffix tree holds a piece's score


def read_model(path: str) -> bytes:
    """The vocabulary's bytes, read where the query is planned and sent to the tasks (under 1 MB)."""
    with open(path, "rb") as file:
        return file.read()


class Pieces:
    """Unigram log-probabilities of a vocabulary, by Zipf's law on the pieces' ranks.

    Pieces are kept as a tree of their characters from the last to the first. A
    character that no piece covers costs ``len(utf-8)`` byte tokens, each as unlikely
    as the rarest piece.
    """

    def __init__(self, ranked: Iterable[str]):
        names = list(dict.fromkeys(ranked))
        total = sum(1 / (r + 1) for r in range(len(names))) or 1.0
        self.tree: dict = {}
        for rank, name in enumerate(names):
            node = self.tree
            for c in reversed(name):
                node = node.setdefault(c, {})
            node[_END] = -math.log((rank + 1) * total)
        self.byte = -math.log((len(names) + 1) * total)

    def counts(self, words: Iterable[str]) -> Iterator[tuple[str, int]]:
        """(word, tokens of its best segmentation) of words in sorted order.

        The best segmentation has the highest sum of log-probabilities, at a tie the
        fewest tokens. ``score[d]`` and ``count[d]`` belong to the prefix of d characters
        of the path from the trie's root to the present word.
        """
        score, count, path = [0.0], [0], ""
        tree, byte = self.tree, self.byte
        for word in words:
            shared = 0
            for a, b in zip(path, word, strict=False):
                if a != b:
                    break
                shared += 1
            del score[shared + 1 :], count[shared + 1 :]
            for end in range(shared, len(word)):
                node = tree.get(word[end])
                if node is None or _END not in node:
                    bytes_ = len(word[end].encode("utf-8", "surrogatepass"))
                    best, fewest = score[end] + bytes_ * byte, count[end] + bytes_
                else:
                    best, fewest = score[end] + node[_END], count[end] + 1
                at = end
                while node is not None and at:
                    at -= 1
                    node = node.get(word[at])
                    if node is not None and _END in node:
                        new = score[at] + node[_END]
                        if new > best or (new == best and count[at] + 1 < fewest):
                            best, fewest = new, count[at] + 1
                score.append(best)
                count.append(fewest)
            path = word
            yield word, count[-1]


@lru_cache(maxsize=2)
def pieces_of(model: bytes) -> Pieces:
    coder = sentencepiece.SentencePieceProcessor(model_proto=model)
    plain = [
        coder.id_to_piece(i)
        for i in range(coder.get_piece_size())
        if not (coder.is_control(i) or coder.is_unknown(i) or coder.is_byte(i))
    ]
    return Pieces(plain)


def _counted(model: bytes, block: int, remembered: int):
    """(id, tag, text) -> (id, tag, n_pretokens, n_tokens)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = pieces_of(model), {}
        for batch in batches:
            texts = texts_of(batch.column(2))
            for first, last in blocks(texts, block):
                split = [texts.data[texts.start[i] : texts.end[i]].tobytes().split() for i in range(first, last)]
                fresh = set().union(*split).difference(known)
                if len(known) + len(fresh) > remembered and known:
                    known, fresh = {}, set().union(*split)
                words = sorted(START + word.decode() for word in fresh)
                for word, n in pieces.counts(words):
                    known[word[1:].encode()] = n
                tokens = [sum(map(known.__getitem__, words)) for words in split]
                n = last - first
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        batch.column(1).slice(first, n),
                        pa.array(np.array([len(words) for words in split], dtype=np.int64)),
                        pa.array(np.array(tokens, dtype=np.int64)),
                    ],
                    names=["long_id", "tag", "n_pretokens", "n_tokens"],
                )

    return run


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_path: str = MODEL,
    block: int = BLOCK,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """(id, tag, n_pretokens, n_tokens) of every whole text.

    Pre-tokens are runs ``[^\\x20\\x09-\\x0D]+``, each with the vocabulary's word mark in
    front; a text's tokens are those of its pre-tokens' best segmentations (see
    ``Pieces``). Null, empty and blank texts have none. Ids may be null or repeat:
    every row gets a row. Other columns are not read; no rows give no rows. There is
    no shuffle; a task holds one block's pre-tokens and ``remembered`` counts.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("long_id"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text")
    )
    run = _counted(read_model(model_path), block, remembered)
    out = rows.mapInArrow(run, "long_id long, tag long, n_pretokens long, n_tokens long")
    return out.withColumnRenamed("long_id", id_col)


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents")).select("doc_id", "n_pretokens", "n_tokens")
