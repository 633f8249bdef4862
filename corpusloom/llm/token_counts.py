"""Exact token counts at every prefix of a text, for a BPE vocabulary with byte fallback.

Prefix dynamic programming: the encoding of a prefix ends in exactly one piece.
``last[i]`` is that piece for the prefix of i characters and
``count[i] = count[i - len(last[i])] + 1``; a piece ending at i is the right one
if it and ``last[i - len(piece)]`` may stand side by side, that is, if no merge
across their border would come before a merge inside them.  No text is encoded
twice, whatever truncation or budget is asked for later.

No piece of the vocabulary holds a word-begin mark after another character, so
the recursion restarts at each such mark; counts of the chunks between marks are
kept in a bounded per-process memory and summed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
LIMIT = 4096
#: Chunks kept per Python process before the memory is emptied.
KEPT = 500_000
#: Characters of text handled together, about.
PORTION = 4_000_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PrefixCounter:
    """Token counts of all prefixes under the pieces and scores of one model file."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.score = {
            sp.id_to_piece(i): sp.get_score(i)
            for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))
        }
        #: Every end of a piece, where the search for pieces that end at a character may go on.
        self.tails = {p[k:] for p in self.score for k in range(len(p))}
        self.totals: dict[str, int] = {}
        self._pairs: dict[tuple[str, str], bool] = {}
        self._spines: dict[str, tuple[list, list]] = {}

    def _merged(self, piece: str) -> dict[tuple[int, int], float]:
        """The spans that merging the piece's characters builds, with their scores."""
        spans = [(i, i + 1) for i in range(len(piece))]
        built: dict[tuple[int, int], float] = {}
        while len(spans) > 1:
            best = None
            for k in range(len(spans) - 1):
                s = self.score.get(piece[spans[k][0] : spans[k + 1][1]])
                if s is not None and (best is None or s > best[0]):
                    best = (s, k)
            if best is None:
                break
            s, k = best
            spans[k : k + 2] = [(spans[k][0], spans[k + 1][1])]
            built[spans[k]] = s
        return built

    def _spine(self, piece: str) -> tuple[list, list]:
        """What stands at the piece's first and last character over time: (text, score of the merge that makes it)."""
        found = self._spines.get(piece)
        if found is None:
            built, n = self._merged(piece), len(piece)
            left = [(piece[0], None), *((piece[:e], s) for (b, e), s in sorted(built.items(), key=lambda x: x[0][1] - x[0][0]) if b == 0)]
            right = [(piece[-1], None), *((piece[b:], s) for (b, e), s in sorted(built.items(), key=lambda x: x[0][1] - x[0][0]) if e == n)]
            found = self._spines[piece] = (left, right)
        return found

    def _beside(self, a: str, b: str) -> bool:
        """Whether the encoding of a + b is a, b."""
        key = (a, b)
        found = self._pairs.get(key)
        if found is not None:
            return found
        if a not in self.score or b not in self.score:  # spelled as bytes, which never merge
            ok = True
        else:
            right, left = self._spine(a)[1], self._spine(b)[0]
            i = j = 0
            ok = True
            while True:
                across = self.score.get(right[i][0] + left[j][0])
                up = right[i + 1][1] if i + 1 < len(right) else None
                down = left[j + 1][1] if j + 1 < len(left) else None
                if across is not None and (up is None or across > up) and (down is None or across >= down):
                    ok = False
                    break
                if up is None and down is None:
                    break
                if down is None or (up is not None and up >= down):
                    i += 1
                else:
                    j += 1
        if len(self._pairs) > 2_000_000:
            self._pairs.clear()
        self._pairs[key] = ok
        return ok

    def _extend(self, s: str, count: list[int], last: list[str]) -> None:
        """Continues the recursion over the rest of a chunk, whose first characters are done."""
        score, tails, pairs = self.score, self.tails, self._pairs
        for i in range(len(count), len(s) + 1):
            fits, b = [], i - 1
            while b >= 0:
                p = s[b:i]
                if p in score:
                    fits.append(b)
                elif p not in tails:
                    break
                b -= 1
            for b in reversed(fits):
                p = s[b:i]
                if b:
                    beside = pairs.get((last[b], p))
                    if beside is None:
                        beside = self._beside(last[b], p)
                    if not beside:
                        continue
                count.append(count[b] + 1)
                last.append(p)
                break
            else:
                p = s[i - 1]
                count.append(count[i - 1] + (1 if p in score else len(p.encode("utf-8", "surrogatepass"))))
                last.append(p)

    def chunk(self, s: str) -> list[int]:
        """Counts of the prefixes of 0, 1, 2, ... characters of one chunk."""
        count, last = [0], [""]
        self._extend(s, count, last)
        return count

    def learn(self, chunks: set[str]) -> None:
        """Puts the totals of the chunks into the memory.

        In sorted order a chunk shares its first characters with the one before,
        and so that part of the recursion.
        """
        if len(self.totals) > KEPT:
            self.totals.clear()
        before, count, last = "", [0], [""]
        for s in sorted(chunks.difference(self.totals)):
            k, most = 0, min(len(s), len(before))
            while k < most and s[k] == before[k]:
                k += 1
            del count[k + 1 :], last[k + 1 :]
            self._extend(s, count, last)
            self.totals[s] = count[-1]
            before = s

    @staticmethod
    def chunks(text: str | None) -> list[str]:
        return CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []

    def count_all(self, texts: list[str | None], limit: int) -> list[tuple[int, int]]:
        """(tokens, characters of the longest prefix within the limit) of each text."""
        out: list[tuple[int, int]] = []
        at = 0
        while at < len(texts):
            parts, size = [], 0
            while at < len(texts) and (not parts or size < PORTION):
                parts.append((texts[at], self.chunks(texts[at])))
                size += len(texts[at] or "")
                at += 1
            self.learn({c for _, cs in parts for c in cs})
            for text, cs in parts:
                sizes = list(map(self.totals.__getitem__, cs))
                total = sum(sizes)
                out.append((total, self._fitting(cs, sizes, limit) if total > limit else len(text or "")))
        return out

    def total(self, text: str | None) -> int:
        return self.count_all([text], 1 << 62)[0][0]

    def prefixes(self, text: str | None) -> list[int]:
        """The count for each prefix of 0, 1, ..., n characters; the empty one has none."""
        out, base = [0], 0
        for c in self.chunks(text):
            counts = self.chunk(c)
            out.extend([base + k for k in counts[1:]])
            base += counts[-1]
        return [0, *out[2:]]  # the mark before the text is no character of it

    def _fitting(self, cs: list[str], sizes: list[int], limit: int) -> int:
        """Characters of the longest prefix with at most ``limit`` tokens."""
        ends = list(accumulate(sizes))
        at = bisect_right(ends, limit)
        best, begin = 0, sum(map(len, cs[:at])) - 1
        # A prefix that ends inside a chunk may need fewer tokens than the chunk, so every chunk that begins within the limit counts.
        while at < len(cs) and (ends[at - 1] if at else 0) <= limit:
            base = ends[at - 1] if at else 0
            inside = [k for k, c in enumerate(self.chunk(cs[at])) if base + c <= limit]
            best = max(best, begin + inside[-1])
            begin += len(cs[at])
            at += 1
        return max(best, 0)

    def fitting(self, text: str | None, limit: int) -> int:
        return self.count_all([text], limit)[0][1]


@lru_cache(maxsize=2)
def counter(model: str) -> PrefixCounter:
    return PrefixCounter(model)


def count_tokens(docs: DataFrame, limit: int = LIMIT, model: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fitting_chars) of every row.

    ``fitting_chars`` is the length of the longest prefix within the limit.
    Null and empty texts have 0 bytes and tokens.  One narrow pass, no shuffle;
    repeated rows give repeated results, other columns are ignored.
    """
    path = model or default_model()

    def batches(it):
        c = counter(path)
        for batch in it:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counted = c.count_all(texts, limit)
            tokens, fitting = [k for k, _ in counted], [n for _, n in counted]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([k > limit for k in tokens], pa.bool_()),
                    pa.array(fitting, pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fitting_chars"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        batches, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fitting_chars long"
    )


def prefix_table(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, counts): the count for every prefix length 0..n, for later questions in SQL."""
    path = model or default_model()

    def batches(it):
        c = counter(path)
        for batch in it:
            counts = [c.prefixes(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "counts"]
            )

    return docs.select("doc_id", "text").mapInArrow(batches, "doc_id long, counts array<int>")


def tokens_of_prefix(prefixes: DataFrame, chars: int) -> DataFrame:
    """(doc_id, n_tokens) of each text cut to its first ``chars`` characters, read off the table."""
    at = F.least(F.size("counts"), F.lit(chars + 1))
    return prefixes.select("doc_id", F.element_at("counts", at).alias("n_tokens"))


def longest_within(prefixes: DataFrame, limit: int) -> DataFrame:
    """(doc_id, chars): the longest prefix of at most ``limit`` tokens, read off the table."""
    fits = F.filter(F.transform("counts", lambda c, i: F.when(c <= limit, i)), lambda i: i.isNotNull())
    return prefixes.select("doc_id", F.array_max(fits).alias("chars"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), LIMIT)
