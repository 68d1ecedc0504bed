"""Operator 4: token counts with a whole-token shortcut.

Offline, on the driver, every string of the vocabulary is encoded alone; those that come
out as the one token they are form the *whole tokens* (a proven set, bounded by the
vocabulary, broadcast).  On the executors a text is cut into the pre-tokens the library
would make.  A pre-token that is a whole token counts one; the others are merged by the
library's model, and their counts are kept in a bounded memo.

The pre-token pattern needs the library's idea of letters, numbers and white space.  The
two agree on all code points below U+0500 (a test compares them one by one).  Text with later code
points is cut at spaces before a safe character, where the pattern always has a boundary;
chunks that hold a later code point go to the library whole.

Edge cases: null and empty texts have 0 bytes and 0 tokens; repeated rows give repeated
results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import byte_texts, slices
from .word_ids import BYTE_LETTER, load_tokenizer

#: What the byte-level pre-tokenizer of the vocabulary file splits on (a fixed value of that format).
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
             r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
SAFE_END = "Ԁ"
CUT = regex.compile(r"(?= [!-~¡-ɏ])")
MEMO_ENTRIES = 300_000


def _byte_level(path: str) -> bool:
    """The file is a byte-level BPE with the pattern above and no normaliser."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    model = spec.get("model") or {}
    return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") is True
            and pre.get("add_prefix_space") is False and model.get("type") == "BPE" and not model.get("dropout")
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized")
                        for t in spec.get("added_tokens", [])))


def whole_tokens(path: str) -> list[str]:
    """Vocabulary strings proven to encode alone as the one token they are."""
    if not _byte_level(path):
        return []
    tok = load_tokenizer(path)
    byte_of = {c: b for b, c in enumerate(BYTE_LETTER)}
    found = []
    for entry, i in tok.get_vocab(False).items():
        try:
            text = bytes([byte_of[c] for c in entry]).decode()
        except (KeyError, UnicodeDecodeError):
            continue  # an added token, or a part of a character: never a pre-token by itself
        if tok.encode(text, add_special_tokens=False).ids == [i]:
            found.append(text)
    return found


class TokenCounter:
    def __init__(self, path: str, whole: list[str]):
        self.fast = _byte_level(path)
        if path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.library = lambda text: len(sp.encode(text, num_threads=1))
            return
        self.tok = load_tokenizer(path)
        self.library = lambda text: len(self.tok.encode(text, add_special_tokens=False).ids)
        self.whole = dict.fromkeys(whole, 1)
        self.memo = dict(self.whole)
        self.find = regex.compile(PRE_TOKEN).findall
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None

    def _safe(self, text: str) -> int:
        tokens, memo = self.find(text), self.memo
        try:
            return sum([memo[t] for t in tokens])
        except KeyError:
            merge = self.tok.model.tokenize
            for t in set(tokens).difference(memo):
                memo[t] = len(merge("".join([BYTE_LETTER[b] for b in t.encode()])))
            return sum([memo[t] for t in tokens])

    def _part(self, text: str) -> int:
        if text.isascii() or max(text) < SAFE_END:
            return self._safe(text)
        return sum(self._safe(c) if max(c) < SAFE_END else self.library(c) for c in CUT.split(text) if c)

    def count(self, text: str) -> int:
        if not self.fast:
            return self.library(text)
        if len(self.memo) > MEMO_ENTRIES:
            self.memo = dict(self.whole)
        if self.added is None or not self.added.search(text):
            return self._part(text) if text else 0
        parts = self.added.split(text)
        return len(parts) - 1 + sum(self._part(p) for p in parts if p)


_LOADED: dict[str, TokenCounter] = {}


def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row of ``docs``; see the module's notes."""
    spark = docs.sparkSession
    whole = spark.sparkContext.broadcast(whole_tokens(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = TokenCounter(path, whole.value)
        counter = _LOADED[path]
        for b in slices(batches):
            texts = byte_texts(b.column(1))
            n = [counter.count(t.decode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)
