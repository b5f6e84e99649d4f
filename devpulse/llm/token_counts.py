"""Exact token counts at every prefix of a text, by dynamic programming.

The encoding of a string ends in exactly one token, so a word needs one table
over its prefixes: the last token of ``w[:j]`` is the token ``t`` with
``t == w[j-len(t):j]`` that can follow the last token of ``w[:j-len(t)]``,
that is, where the merges leave the two tokens apart. The count at ``j`` is
one more than the count before ``t``. Two tables are kept, for a prefix inside
a word and for a prefix that ends there (its last byte carries the word end).
Short words share their prefixes, so the states are stored by prefix in a
bounded table of the Python worker. A long word has its states in arrays by
position, which are dropped with the word: memory follows its length.

Over a text, counts add up word by word. ``PrefixCounts`` answers the count of
any prefix and the longest prefix within a budget from these stored counts;
nothing is encoded again.

Positions are code points of the text after NFC; texts holding special strings
are cut there and a prefix ending inside a special string counts that string's
part as ordinary text. Defined results: a null or empty text has 0 bytes and 0
tokens; repeated rows give repeated results.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections.abc import Sequence
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devpulse.llm.batches import slices
from devpulse.llm.wordbpe import END, lower_of, nfc, normalise, split_normal, vocabulary

#: Chunks, prefix states and token pairs kept by a Python worker.
TABLE_CHUNKS = 300_000
TABLE_STATES = 300_000
TABLE_PAIRS = 500_000
#: Bytes of words whose prefixes are stored by string, and code points of stored chunks.
SHORT = 256


class WordCounter:
    """Token counts of words and of their prefixes."""

    def __init__(self, path: str):
        self.vocabulary = v = vocabulary(path)
        self.rank = {m: i for i, m in enumerate(v.merges)}
        self.map = dict(enumerate(v.letters))
        self.longest = max(len(t.removesuffix(END)) for t in v.ids)
        single = [t for t in v.ids if self._merge(t) == [t]]
        self.inner = {t: len(t) for t in single if not t.endswith(END)}
        self.final = {t.removesuffix(END) for t in single if t.endswith(END)}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.states: dict[str, tuple[int, str]] = {"": (0, "")}
        self.chunks: dict[str, int] = {}

    def _merge(self, text: str) -> list[str]:
        """The merges over a short mapped string; ``</w>`` belongs to the last letter."""
        end = text.endswith(END) and text != END
        parts = list(text.removesuffix(END) if end else text)
        if end:
            parts[-1] += END
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: self.rank.get(p, len(self.rank)))
            if best not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _apart(self, left: str, right: str) -> bool:
        """Whether the merges keep the two tokens as they are."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= TABLE_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._merge(left + right) == [left, right]
        return known

    def _state(self, text: str) -> tuple[int, str]:
        """Count and last token of a mapped prefix inside a word."""
        states = self.states
        known = states.get(text)
        if known is not None:
            return known
        j = len(text)
        while text[:j] not in states:
            j -= 1
        for j in range(j + 1, len(text) + 1):
            for i in range(max(0, j - self.longest), j):
                token = text[i:j]
                if token in self.inner:
                    count, last = states[text[:i]] if text[:i] in states else self._state(text[:i])
                    if not last or self._apart(last, token):
                        states[text[:j]] = (count + 1, token)
                        break
        return states[text]

    def _final(self, text: str) -> int:
        """Count of a mapped string as a whole word."""
        if len(text) > SHORT:
            return self._ends(text, [len(text)])[0]
        if len(self.states) >= TABLE_STATES:
            self.states = {"": (0, "")}
        for i in range(max(0, len(text) - self.longest), len(text)):
            if text[i:] in self.final:
                count, last = self._state(text[:i])
                if not last or self._apart(last, text[i:] + END):
                    return count + 1
        raise ValueError("the vocabulary lacks a byte")

    def _ends(self, text: str, places: Sequence[int]) -> list[int]:
        """Counts of the mapped strings ``text[:j]`` as whole words, for the ascending ``places`` j."""
        counts, lengths = array("q", [0]), array("q", [0])  # of the prefixes inside the word: count, last token's length

        def apart(i: int, token: str) -> bool:
            return not i or self._apart(text[i - lengths[i]:i], token)

        for j in range(1, places[-1]):
            i = next(i for i in range(max(0, j - self.longest), j) if text[i:j] in self.inner and apart(i, text[i:j]))
            counts.append(counts[i] + 1)
            lengths.append(j - i)
        return [next(counts[i] + 1 for i in range(max(0, j - self.longest), j)
                     if text[i:j] in self.final and apart(i, text[i:j] + END)) for j in places]

    def prefix_counts(self, word: str) -> list[int]:
        """Tokens of ``word[:1]``, ``word[:2]`` and so on, of one normalised word, in one pass."""
        return self._ends(self.mapped(word), list(accumulate(len(self.mapped(c)) for c in word)))

    def count(self, chunk: str) -> int:
        """Tokens of a normalised text without special strings."""
        known = self.chunks.get(chunk)
        if known is None:
            known = sum(self._final(self.mapped(w)) for w in split_normal(chunk))
            if len(chunk) <= SHORT:
                if len(self.chunks) >= TABLE_CHUNKS:
                    self.chunks.clear()
                self.chunks[chunk] = known
        return known

    def mapped(self, word: str) -> str:
        return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.map)

    def total(self, text: str) -> int:
        special, get = self.vocabulary.marked, self.chunks.get
        total = 0
        for c in self.vocabulary.chunks(text):
            n = get(c)
            total += n if n is not None else 1 if c in special else self.count(c)
        return total

    def prefixes(self, text: str) -> PrefixCounts:
        return PrefixCounts(self, text)


class PrefixCounts:
    """Counts at every prefix of one text: word ends and running counts are stored."""

    def __init__(self, counter: WordCounter, text: str):
        self.counter = counter
        self.text = nfc(text)
        self.ends, self.counts = [0], [0]
        v = counter.vocabulary
        pieces = v.special_pattern.split(text) if v.special_pattern else [text]
        at = total = 0
        for piece in pieces:
            if piece in v.special:
                at, total = at + len(piece), total + 1
                self.ends.append(at)
                self.counts.append(total)
                continue
            raw = nfc(piece)
            low = normalise(piece)
            starts = None if len(low) == len(raw) else _origins(raw)
            end = 0
            for word in split_normal(low):
                end = low.index(word, end) + len(word)
                total += counter.count(word)
                self.ends.append(at + (end if starts is None else starts[end - 1] + 1))
                self.counts.append(total)
            at += len(raw)

    def total(self) -> int:
        return self.counts[-1]

    def at(self, n: int) -> int:
        """The token count of the first ``n`` code points."""
        k = bisect_right(self.ends, n) - 1
        return self.counts[k] + self.counter.count(normalise(self.text[self.ends[k]:n]))

    def longest(self, budget: int) -> int:
        """Code points of the longest prefix that ends with a word, or inside one at a place where
        the count still fits, with at most ``budget`` tokens."""
        k = bisect_right(self.counts, budget) - 1
        if k == len(self.counts) - 1:
            return len(self.text)
        n, last = self.ends[k], self.ends[k + 1] - 1
        if last - n > SHORT and len(words := split_normal(low := normalise(self.text[n:last]))) == 1 and \
                len(low) == last - n and low.endswith(words[0]):
            # A long word (after white space): all its prefixes in one pass.
            counts = self.counter.prefix_counts(words[0])
            while counts and self.counts[k] + counts[-1] > budget:
                counts.pop()
            return last - len(words[0]) + len(counts)
        for m in range(last, n, -1):
            if self.at(m) <= budget:
                return m
        return n


def _origins(raw: str) -> list[int]:
    """For each code point of the lower-cased text, the code point it comes from."""
    return [i for i, c in enumerate(raw) for _ in lower_of(c)]


@lru_cache(2)
def counter(path: str) -> WordCounter:
    return WordCounter(path)


def token_counts(df: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit, fit_chars``: ``fit_chars`` code points (after NFC) fit the limit.

    A map over the rows; the prefix table of a text lives in its task only while the text is counted.
    """

    def run(batches):
        c = counter(path)
        for batch in slices(batches, 1):
            n_bytes, n_tokens, fit = [], [], []
            for t in batch.column(1).to_pylist():
                t = t or ""
                n_bytes.append(len(t.encode("utf-8", "surrogatepass")))
                if (n := c.total(t)) > limit:
                    table = c.prefixes(t)
                    n = table.total()
                    fit.append(table.longest(limit))
                else:
                    fit.append(len(nfc(t)))
                n_tokens.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_()), pa.array(fit, pa.int64())],
                ["key", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
                           T.StructField("fit_chars", T.LongType())])
    return (df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, schema).withColumnRenamed("key", key))


