"""Token counts by trie-shared dynamic programming.

The tokens of a pre-token are the segmentation with the best sum of unigram scores. A task inserts its distinct
pre-tokens in a trie; each new node gets the best score of its prefix, reached from the nodes of shorter prefixes, so a
shared prefix is worked out once. Nodes where a pre-token ends store its number of tokens, which later texts look up.

Nothing is shuffled. A trie is dropped when it has ``MOST_NODES`` nodes, and the counts taken from it after a text when
there are ``MOST_WORDS``; results do not depend on that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_NODES = 300_000
MOST_WORDS = 200_000
MARK = "▁"
LETTERS = 0x110000  # code points


class Unigrams:
    """Pieces of a vocabulary file with scores.

    A piece's score is the logarithm of its Zipf frequency, by its rank in the file; the file's own scores are such
    ranks. A character outside the vocabulary costs as many tokens as it has UTF-8 bytes, with the score of the rarest
    piece for each.
    """

    def __init__(self, pieces: list[str]) -> None:
        total = math.log(len(pieces) + 1) + 0.5772156649
        self.scores = {p: -math.log(i + 1) - math.log(total) for i, p in enumerate(pieces)}
        self.rarest = -math.log(len(pieces) + 1) - math.log(total)
        self.longest = max(map(len, pieces), default=1)
        self.endings = {p[i:] for p in pieces for i in range(len(p))}

    @classmethod
    def from_file(cls, path: str) -> Unigrams:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        return cls([model.id_to_piece(i) for i in range(model.get_piece_size()) if not special(i)])


class Trie:
    """Pre-tokens with the best score and token count of every prefix."""

    def __init__(self, unigrams: Unigrams) -> None:
        self.unigrams = unigrams
        self.clear()

    def clear(self) -> None:
        self.children: dict[int, int] = {}  # by node and character
        self.best, self.tokens = [0.0], [0]

    def insert(self, word: str) -> int:
        """The number of tokens of ``word``; only nodes that are new are worked out."""
        children, node, path = self.children, 0, [0]
        known = 0
        for c in word:
            node = children.get(node * LETTERS + ord(c), -1)
            if node < 0:
                break
            path.append(node)
            known += 1
        scores, endings, best, tokens = self.unigrams.scores, self.unigrams.endings, self.best, self.tokens
        for end in range(known + 1, len(word) + 1):
            c = word[end - 1]
            width = len(c.encode("utf-8", "surrogatepass"))
            before = path[end - 1]
            top, count = best[before] + width * self.unigrams.rarest, tokens[before] + width
            for start in range(end - 1, -1, -1):
                piece = word[start:end]
                if piece not in endings:  # no longer piece ends like this
                    break
                score = scores.get(piece)
                if score is not None:
                    score += best[path[start]]
                    if score > top or score == top and tokens[path[start]] + 1 < count:
                        top, count = score, tokens[path[start]] + 1
            children[before * LETTERS + ord(c)] = len(best)
            path.append(len(best))
            best.append(top)
            tokens.append(count)
        return tokens[path[-1]]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known = Trie(Unigrams.from_file(path)), {}
        for batch in batches:
            words, sums = [], []
            for text in batch.column(1):
                parts = (text.as_py() or "").split()
                counts = list(map(known.get, parts))
                if None in counts:
                    for word in sorted({p for p, n in zip(parts, counts) if n is None}):
                        known[word] = trie.insert(MARK + word)
                        if len(trie.best) > MOST_NODES:
                            trie.clear()
                    counts = list(map(known.get, parts))
                words.append(len(parts))
                sums.append(sum(counts))
                if len(known) > MOST_WORDS:
                    known.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(words, np.int64)), pa.array(np.array(sums, np.int64))], names=["doc_id", "n_words", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_words and n_tokens of every row of ``docs`` (``doc_id``, ``text``).

    Pre-tokens are the runs of a text without white space (as Python's ``str.split`` sees it), each with a mark before
    it. Null, empty and white texts have no token. Repeated rows get equal results, an empty table an empty one, and other
    columns are left out. ``vocabulary`` is the path of a sentencepiece model.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_count(vocabulary), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_tokens long")
