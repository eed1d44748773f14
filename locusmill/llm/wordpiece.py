"""Token counts by a linear longest-match automaton.

The vocabulary is a trie with two roots: pieces that begin a word, and pieces that go on in one. Where no edge goes
on, a node's failure link leads to the node that the longest match would leave one in, and the number of pieces that
this pops is stored with it. A word is read once, byte by byte; counts are added, pieces are never built.

Defined results: null and empty texts have no words and no pieces. A word that the vocabulary cannot cover counts as one
(unknown) piece, as a whole. Repeated rows give equal rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import as_bytes, map_batches, per_worker, table

VOCABULARY = "byte_bpe_50k"
KEPT_WORDS, LONG_WORD = 400_000, 48
SCHEMA = "doc_id long, n_words long, n_pieces long"


class Automaton:
    FIRST, NEXT = 0, 1  # the two roots

    def __init__(self, first: Iterable[bytes], later: Iterable[bytes]):
        """first: pieces at the start of a word. later: pieces within it."""
        step: dict[int, int] = {}  # node << 8 | byte: node
        ends: set[int] = set()
        size = 2
        for root, pieces in ((self.FIRST, first), (self.NEXT, later)):
            for piece in pieces:
                node = root
                for c in piece:
                    node, was = step.setdefault(node << 8 | c, size), size
                    size += node == was
                if piece:
                    ends.add(node)
        fail, popped = [-1] * size, [0] * size
        # a node's number is above its parent's, but its failure node may be deeper in the other tree: go by depth
        children: dict[int, list[tuple[int, int]]] = {}
        for key, node in step.items():
            children.setdefault(key >> 8, []).append((key & 255, node))
        level = [self.FIRST, self.NEXT]
        while level:
            below = []
            for parent in level:
                for c, node in children.get(parent, ()):
                    below.append(node)
                    if node in ends:
                        fail[node], popped[node] = self.NEXT, 1
                        continue
                    z, n = fail[parent], popped[parent]
                    while z >= 0 and z << 8 | c not in step:
                        n += popped[z]
                        z = fail[z]
                    if z >= 0:
                        fail[node], popped[node] = step[z << 8 | c], n
            level = below
        self.step, self.fail, self.popped = step, fail, popped

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest-match split; 1 if there is none."""
        step, fail, popped, node, n = self.step, self.fail, self.popped, self.FIRST, 0
        for c in word:
            while (to := step.get(node << 8 | c, -1)) < 0:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = to
        while node > self.NEXT:
            n += popped[node]
            node = fail[node]
        return n if node == self.NEXT or not word else 1


def automaton(vocabulary: str = VOCABULARY) -> Automaton:
    """Pieces with a leading space begin words; the others go on in them."""
    import public_tokenizers

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        pieces = [base64.b64decode(x.split()[0]) for x in f]
    return Automaton([x for x in pieces if x[:1] == b" "], [x for x in pieces if x[:1] != b" "])


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    def rows(b: pa.RecordBatch) -> pa.RecordBatch:
        count = per_worker(f"automaton {vocabulary}", lambda: automaton(vocabulary)).count
        known: dict[bytes, int] = per_worker(f"counts {vocabulary}", dict)
        n_words, n_pieces = [], []
        for raw in as_bytes(b.column(1)):
            words = (raw or b"").split()
            total = 0
            for w in words:
                n = known.get(w)
                if n is None:
                    n = count(b" " + w)
                    if len(w) <= LONG_WORD:
                        known[w] = n
                total += n
            n_words.append(len(words))
            n_pieces.append(total)
            if len(known) > KEPT_WORDS:
                known.clear()
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_pieces, pa.int64())], ["doc_id", "n_words", "n_pieces"])

    return map_batches(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), rows, SCHEMA)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
