"""Token counts under a unigram model, by dynamic programming on a trie of the distinct pre-tokens.

A pre-token is a run of characters that aren't white space, with the word mark in front. Its best segmentation is the
one with the largest sum of piece scores, of equal sums the one with the fewest tokens. The forward score of a prefix
depends on the prefix alone, so the distinct pre-tokens of a batch are put in a trie, each of whose nodes gets its
forward score once, and each terminal the number of tokens. Sorted pre-tokens are that trie in preorder: the states up
to the common prefix with the word before are still there, and only the rest is computed.

The pieces are those of a public vocabulary. It holds no unigram scores, so they follow from the ranks by Zipf's law:
-log(rank) in thousandths, as whole numbers. A character that is no piece costs its UTF-8 bytes, one token each.

There is no shuffle; a task keeps the counts of at most ``CACHE`` short words. Defined results: a null or blank text has
no words and no tokens; repeated rows are counted alike; an empty table gives an empty result; other columns are ignored.
"""

import math
import re
from functools import cache

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import map_rows

MARK = "▁"
CACHE = 1 << 20
SHORT = 64
PIECE = 1 << 20
WHITE = re.compile(r"\s")


@cache
def pieces(vocabulary: str) -> tuple[dict[str, int], int, int]:
    """Score of each piece, the score of a byte, and the length of the longest piece."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    scores = {model.id_to_piece(i): round(-1000 * math.log(rank)) for rank, i in enumerate(plain, 1)}
    return scores, round(-1000 * math.log(size)), max(map(len, scores))


def trie_counts(words: list[str], scores: dict[str, int], byte: int, longest: int) -> list[int]:
    """The number of tokens of each of the sorted distinct ``words``."""
    out, before = [], ""
    best, tokens = [0], [0]  # of each prefix on the way from the root to the last terminal
    for word in words:
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del best[shared + 1 :], tokens[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            top, n = None, 0
            for start in range(max(0, end - longest), end):
                score = scores.get(word[start:end])
                used = 1
                if score is None:
                    if start < end - 1:
                        continue
                    used = len(word[start:end].encode("utf-8", "surrogatepass"))
                    score = byte * used
                score += best[start]
                used += tokens[start]
                if top is None or score > top or score == top and used < n:
                    top, n = score, used
            best.append(top)
            tokens.append(n)
        out.append(tokens[-1])
        before = word
    return out


def words_of(text: str | None):
    """Lists of the words of a text; long texts come in several, cut at white space."""
    text, at = text or "", 0
    while at < len(text):
        cut = WHITE.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def count_tokens(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_words, n_tokens."""
    known: dict[str, int] = {}  # of a task; the closure is copied to each

    def learn(words: set[str]) -> dict[str, int]:
        scores, byte, longest = pieces(vocabulary)
        if len(known) > CACHE:
            known.clear()
        new = sorted(MARK + w for w in words if w not in known)
        found = {w[1:]: n for w, n in zip(new, trie_counts(new, scores, byte, longest), strict=True)}
        long = {w: found.pop(w) for w in [w for w in found if len(w) > SHORT]}
        known.update(found)
        return long

    def one(batch: pa.RecordBatch) -> list[tuple]:
        out = []
        ids = batch["doc_id"].to_pylist()
        for i in range(0, len(batch), 128):
            parts = [list(words_of(t.as_py())) for t in batch["text"].slice(i, 128)] if len(batch) else []
            long = learn(set().union(*(ws for doc in parts for ws in doc)))
            for doc_id, doc in zip(ids[i : i + 128], parts, strict=True):
                n = sum(long[w] if w in long else known[w] for ws in doc for w in ws) if long else sum(sum(map(known.__getitem__, ws)) for ws in doc)
                out.append((doc_id, sum(map(len, doc)), n))
        return out

    return map_rows(docs.select("doc_id", "text"), one, "doc_id bigint, n_words bigint, n_tokens bigint")
