"""Token counts under a unigram vocabulary by dynamic programming shared over a trie.

A pre-token is a word (a run of characters other than space and 0x09-0x0D)
with the vocabulary's word mark in front.  The distinct pre-tokens of a chunk
are walked in sorted order, which is a depth-first walk of their trie: forward
scores are computed once for each shared prefix, and each terminal stores the
number of tokens of its best segmentation.  Equal scores go to fewer tokens.
A character outside the vocabulary costs one byte token for each UTF-8 byte.

The public vocabulary holds pieces in order of merging, not probabilities; the
unigram score of a piece is the Zipf law of its rank.

Each task walks its own pre-tokens and remembers up to ``REMEMBERED`` of them,
so the text is read once and nothing is shuffled.

Defined results: a null or empty text has no pre-token and no token; repeated
rows count alike; other columns pass through, except ``n_pretokens`` and
``n_tokens``, which are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm._arrow import add_columns
from quillon.llm._words import words

MARK = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_PENALTY = 30.0
REMEMBERED = 1 << 20


def zipf_scores(path: str = VOCABULARY) -> dict[str, float]:
    """Log scores of the vocabulary's ordinary pieces, read on the driver; the file is never copied."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = math.log(sum(1 / (i + 1) for i in range(len(pieces))))
    return {p: -math.log(i + 1) - total for i, p in enumerate(pieces)}


class SuffixTrie:
    """Pieces by their characters from the last to the first, to find those that end at a position."""

    def __init__(self, scores: dict[str, float]):
        self.root: dict = {}
        for piece, score in scores.items():
            node = self.root
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = score

    def counts(self, pretokens: list[str]) -> dict[str, int]:
        """Tokens of the best segmentation of each pre-token; ``pretokens`` are sorted."""
        out: dict[str, int] = {}
        best, tokens = [0.0], [0]
        last = ""
        for word in pretokens:
            same = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                same += 1
            del best[same + 1 :], tokens[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                wide = len(word[end - 1].encode("utf-8", "surrogatepass"))
                top, fewest = best[end - 1] - BYTE_PENALTY * wide, tokens[end - 1] + wide
                node, at = self.root, end
                while at:
                    at -= 1
                    node = node.get(word[at])
                    if node is None:
                        break
                    score = node.get("")
                    if score is not None:
                        score += best[at]
                        if score > top or score == top and tokens[at] + 1 < fewest:
                            top, fewest = score, tokens[at] + 1
                best.append(top)
                tokens.append(fewest)
            out[word] = tokens[-1]
            last = word
        return out


def count_tokens(docs: DataFrame, scores: dict[str, float]) -> DataFrame:
    """``docs`` with ``n_pretokens`` and ``n_tokens`` of the column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(scores)  # the vocabulary: a fixed file

    def make():
        trie = SuffixTrie(shared.value)
        known, known_count = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def work(given):
            nonlocal known, known_count
            n_words, n_tokens = np.zeros(len(given["text"]), np.int64), np.zeros(len(given["text"]), np.int64)
            for w in words(given["text"], lower=False):
                own, where, back = np.unique(w.hashes, return_index=True, return_inverse=True)
                at = np.searchsorted(known, own)
                found = np.zeros(len(own), bool)
                if len(known):
                    found = known[np.minimum(at, len(known) - 1)] == own
                fresh = np.flatnonzero(~found)
                counts = np.zeros(len(own), np.int64)
                counts[found] = known_count[at[found]]
                if len(fresh):
                    spelt = [MARK + w.data[w.starts[i] : w.ends[i]].tobytes().decode("utf-8", "replace") for i in where[fresh]]
                    got = trie.counts(sorted(set(spelt)))
                    counts[fresh] = [got[x] for x in spelt]
                    if len(known) + len(fresh) > REMEMBERED:
                        known, known_count = own, counts
                    else:
                        known_count = np.insert(known_count, at[fresh], counts[fresh])
                        known = np.insert(known, at[fresh], own[fresh])
                sums = np.concatenate([[0], np.cumsum(counts[back])])
                n_words[w.first : w.first + w.rows] = np.diff(w.bounds)
                n_tokens[w.first : w.first + w.rows] = np.diff(sums[w.bounds])
            return {"n_pretokens": n_words, "n_tokens": n_tokens}

        return work

    return add_columns(docs, {"text": F.col("text")}, {"n_pretokens": "long", "n_tokens": "long"}, make)
