"""Token counts with the whole-token shortcut: most words are looked up, only the rest is merged."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from danji.llm.common import ship
from danji.llm.words import by_space, parts, steps

MARK = "▁"
#: Words a worker remembers in each of two generations; older ones are merged again.
REMEMBERED = 300_000


class WordCounts(dict):
    """Tokens of a word (what follows a space, up to the next one) under one sentencepiece model.

    The proof, made once from the vocabulary: if no piece holds a mark after another character,
    no merge crosses from a word to the mark that begins the next, so the words of a text are
    merged independently. A vocabulary string mark + word that encodes, alone, to exactly itself
    is then one token wherever that word stands; those are entered here beforehand.
    """

    def __init__(self, model_file: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        special = {
            i for i in range(len(self.pieces))
            if self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i)
        }
        plain = [p for i, p in enumerate(self.pieces) if i not in special]
        self.separable = self._separable(plain)
        self.whole = self._proven(plain) if self.separable else {}
        self.alone = len(self.model.encode("a ")) - len(self.model.encode("a"))
        self.fixed = {MARK: self.alone, "": 0}
        super().__init__(self.fixed)
        self.old: dict[str, int] = {}

    def _separable(self, plain: list[str]) -> bool:
        crossing = any(MARK in p.lstrip(MARK) for p in plain)
        # The model may neither drop spaces nor rewrite characters.
        probe = "  a b éﬁＡ é Ω"
        same = self.model.decode(self.model.encode(probe)).strip() == probe.strip()
        kept = self.model.encode("a  b", out_type=str) != self.model.encode("a b", out_type=str)
        dummy = self.model.encode("a", out_type=str)[0].startswith(MARK)
        return not crossing and same and kept and dummy

    def _proven(self, plain: list[str]) -> dict[str, int]:
        words = [p[1:] for p in plain if p.startswith(MARK) and len(p) > 1 and MARK not in p[1:]]
        alone = self.model.encode(words, out_type=str, num_threads=1)
        return {w: 1 for w, got in zip(words, alone) if got == [MARK + w]}

    def count_all(self, texts: pa.Array) -> np.ndarray:
        if not self.separable:
            return np.asarray([len(ids) for ids in self.model.encode(texts.to_pylist(), num_threads=1)], np.int64)
        texts = pc.replace_substring(texts, MARK, " ")
        # Spaces that begin or end a text or stand in a row are merged with the word they precede.
        runs = pc.match_substring_regex(texts, "^ |  | $").to_numpy(zero_copy_only=False)
        ends, codes, words = parts(pc.if_else(pa.array(runs), "", texts), by_space)
        counts = np.concatenate([[0], np.cumsum(np.asarray(self._counts(words.to_pylist()), np.int64)[codes])])[ends]
        out = counts[1:] - counts[:-1]
        for i in np.flatnonzero(runs):
            out[i] = sum(self._counts(self._units(texts[int(i)].as_py())))
        return out

    def _units(self, text: str) -> list[str]:
        """The text's words, each with the spaces before it but the one that ended the word before."""
        found, run = [], 0
        for part in text.split(" "):
            if part:
                found.append(" " * run + part)
                run = 0
            else:
                run += 1
        # Spaces at the end are a word of marks; a single one is the mark alone.
        return found + ([" " * (run - 1) if run > 1 else MARK] if run else [])

    def _counts(self, units: list[str]) -> list[int]:
        merge = []
        for unit in units:
            if unit not in self:
                if (n := self.whole.get(unit) or self.old.get(unit)) is None:
                    merge.append(unit)
                else:
                    self[unit] = n
        merge = list(dict.fromkeys(merge))
        self.update(zip(merge, map(len, self.model.encode(merge, num_threads=1))))
        out = [self[u] for u in units]
        if len(self) > REMEMBERED:
            self.old = {u: n for u, n in self.items() if len(u) < 100}
            self.clear()
            self.update(self.fixed)
        return out


@lru_cache(maxsize=2)
def word_counts(model_file: str) -> WordCounts:
    return WordCounts(model_file)


def token_counts(
    docs: DataFrame, model_file: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Counts equal those of the sentencepiece model over the whole text. Rows are independent, there
    is no shuffle; a worker remembers a bounded number of words. A null text counts as empty (0
    bytes, 0 tokens); ids pass through, repeated or null. model_file must exist on every worker.
    """

    def count(batches):
        words = word_counts(model_file)
        for batch in batches:
            counts = [words.count_all(step.column(1)) for step in steps(batch, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"))
    counted = rows.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
