"""Token ids of whole texts from a ``tokenizers`` file, with a bounded memo per chunk.

The word vocabulary (``word_bpe_49k.json``) drops white space before anything else and its
pre-token pattern never spans it, so the ids of a text are the ids of its white-space
separated chunks, one after another.  A column of texts is split, and its distinct chunks are
numbered, by Arrow; of these, the marks at the end are taken off, so a word is one part whatever
stands after it.  Each distinct part's ids are looked up once, and Arrow puts the ids of all
occurrences together.  Parts recur, so each task keeps a memo part -> ids; a part that
isn't in it goes through the library.  The memo is a speed device only: when its young half is full it becomes the old half,
and what isn't asked for again goes with that.  The ids are the library's for any text.

Three facts about the file are checked when it is loaded (``_check``); a file without them is
encoded by the library text by text:
lower-casing is a normaliser (so A-Z may be lowered first), the pre-token pattern has no
alternative that spans white space, and added tokens hold no white space.
A text that holds the first two characters of an added token goes to the library whole,
since added tokens are matched in the raw text, before lower-casing; so does one where a mark follows a capital
that composes otherwise than its small letter (``LOWER_LAST``), since the file composes before it lower-cases.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

MEMO_ENTRIES = 500_000
#: Text that is encoded at a time: the more of it, the more often its chunks recur.
ENCODE_BYTES = 4 << 20
#: The pre-token pattern under which white-space chunks are independent (a fixed value of the vocabulary file).
CHUNK_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def load_tokenizer(path: str) -> Tokenizer:
    """The file's tokenizer without truncation or padding."""
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _check(spec: dict) -> list[str] | None:
    """First two characters of each added token if chunks may be encoded alone, else None."""
    norm = spec.get("normalizer") or {}
    kinds = [n.get("type") for n in norm.get("normalizers", [norm])]
    pre = spec.get("pre_tokenizer") or {}
    parts = pre.get("pretokenizers", [pre])
    split = parts[0] if parts else {}
    ok = (kinds == ["NFC", "Replace", "Lowercase"] and split.get("type") == "Split"
          and split.get("pattern", {}).get("Regex") == CHUNK_PATTERN
          and split.get("behavior") == "Removed" and split.get("invert") is True
          and all(p.get("add_prefix_space", False) is False for p in parts[1:]))
    added = [t["content"] for t in spec.get("added_tokens", [])]
    if not ok or any(a.split() != [a] for a in added):
        return None
    return sorted({a[:2] for a in added})


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 bytes
    stand for themselves, the others for the letters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


BYTE_LETTER = "".join(byte_letters())


#: ASCII that is no letter, digit, white space or apostrophe: after a letter or digit, a run of it is a pre-token of its own.
MARKS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'")
#: Capitals whose composed forms have no counterpart among the small letter's, or the other way round, before a combining mark.
LOWER_LAST = r"[HIJTWY]\p{M}"
#: Letters and digits that a normalised text still has there.  Not so for any letter: a dotted capital I and some letters of
#: Indic scripts and Hebrew become two code points, of which the second joins the marks after it.
ENDS = pa.array([*"0123456789", *(chr(c) for c in range(0x250) if chr(c).isalpha() and c != 0x130)])


def _parts(chunks: pa.StringArray) -> pa.DictionaryArray:
    """Of each chunk what stands before the marks at its end, then these marks (empty where they aren't apart)."""
    heads = pc.ascii_rtrim(chunks, characters=MARKS)
    apart = pc.is_in(pc.utf8_slice_codeunits(heads, -1), value_set=ENDS)
    sizes = pc.if_else(apart, pc.binary_length(heads), pc.binary_length(chunks)).to_numpy()
    starts = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset:chunks.offset + len(chunks) + 1]
    places = np.empty(2 * len(chunks) + 1, np.int32)
    places[::2], places[1::2] = starts, starts[:-1] + sizes
    return pa.StringArray.from_buffers(2 * len(chunks), pa.py_buffer(places), chunks.buffers()[2] or pa.py_buffer(b"")).dictionary_encode()


def _placed(ids: pa.LargeBinaryArray) -> tuple[np.ndarray, pa.Buffer]:
    """Where each row's bytes start (and the last one's end), and the bytes of all rows."""
    _, starts, row = ids.buffers()
    return np.frombuffer(starts, np.int64)[ids.offset:ids.offset + len(ids) + 1], row or pa.py_buffer(b"")


class WordIds:
    """``batch(texts)``: the library's ids (no special tokens added) of each text, as bytes."""

    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES):
        self.tok = load_tokenizer(path)
        with open(path, encoding="utf-8") as f:
            self.added = _check(json.load(f))
        self.whole = "|".join([*map(re.escape, self.added or []), LOWER_LAST])
        #: uint16 holds every id of a vocabulary of up to 65,536 entries
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size(True) <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.limit = memo_entries
        self.merge = self.tok.model.tokenize

    def _library(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _letters(self, word: str) -> bytes | None:
        """Ids of a part of lower-case Latin letters, else None.

        Latin letters up to U+024F hold no combining marks and one pre-token: only the merges are left to do
        (a dotted capital I lower-cases to two code points, one of them a mark)."""
        if not word.isascii():
            low = word.lower()
            if not low.isalpha() or max(word) >= "\u0250":
                return None
            word = low.encode().decode("latin-1").translate(BYTE_LETTER)
        elif not word.isalpha():
            return None
        return array(self.code, [t.id for t in self.merge(word)]).tobytes()

    def _encoded(self, parts: list[str]) -> list[bytes]:
        """The ids of parts that the memo doesn't hold."""
        found = list(map(self._letters, parts))
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, e in zip(rest, self.tok.encode_batch_fast([parts[i] for i in rest], add_special_tokens=False)):
            found[i] = array(self.code, e.ids).tobytes()
        return found

    def _known(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts."""
        if len(self.young) > self.limit // 2:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        found, unknown = list(map(young.get, parts)), []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            if (ids := old.get(parts[i])) is None:
                unknown.append(i)
            else:
                found[i] = young[parts[i]] = ids
        for i, ids in zip(unknown, self._encoded([parts[i] for i in unknown])):
            found[i] = young[parts[i]] = ids
        return found

    def batch(self, texts: pa.Array | list[bytes | None]) -> list[bytes]:
        """Little-endian id bytes (``dtype``) of each text; null is an empty text."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
        column = pc.fill_null(column.cast(pa.string()), "")
        if self.added is None:
            return [self._library(t) for t in column.to_pylist()]
        whole = pc.match_substring_regex(column, self.whole)
        plain = pc.if_else(whole, "", column)
        words = pc.ascii_split_whitespace(pc.ascii_lower(plain))  # [\x20\x09-\x0D], A-Z
        coded = words.flatten().dictionary_encode()
        parts = _parts(coded.dictionary)
        ids = pa.array(self._known(parts.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        # a chunk's ids are those of its two parts, a text's those of its chunks
        starts, row = _placed(ids.take(parts.indices))
        ids = pa.Array.from_buffers(pa.large_binary(), len(coded.dictionary), [None, pa.py_buffer(starts[::2].copy()), row])
        starts, row = _placed(ids.take(coded.indices))
        cuts, row = starts[words.offsets.to_numpy() - words.offsets[0].as_py()], row.to_pybytes()
        out = [row[s:e] for s, e in zip(cuts.tolist(), cuts[1:].tolist())]
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self._library(column[i].as_py())
        return out


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One instance per worker process and file, so the memo outlives a task."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
