"""Byte-level BPE: texts to ids, and ids to bytes, for a ``tokenizers`` file.

Where the file's merges are numbered like its ids (the plain byte-level BPE
scheme), the same vocabulary runs in ``tiktoken``, which gives the same ids
several times faster. Texts with characters whose class differs between
Unicode versions, and files of another kind, go to ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa

#: Fixed value: the pattern that byte-level pre-tokenization splits a text by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Scripts whose letters, digits and marks every Unicode version classes alike (ASCII, Latin, Greek,
#: Cyrillic, punctuation, kana, common ideographs, Hangul) and no longer runs of blanks.
_SETTLED = re.compile("[\0-ɏΑ-ΡΣ-ϿЀ-џ‐-‧‰-⁞€"
                      "、-〩ぁ-ゔァ-ヺ一-龥가-힣]*")
_LONG_BLANKS = re.compile(r"\s{1000}")
#: Texts are encoded in lots of about so many characters.
LOT_CHARS = 1_000_000


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable Latin-1 characters are their own byte; the other bytes, in
    order, are the characters from U+0100 on.
    """
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """Encoder for one file. ``plain_specials``: strings of special tokens in a text are ordinary text."""

    def __init__(self, path: str, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tok.encode_special_tokens = plain_specials
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, added = byte_letters(), {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*spec["model"]["vocab"].values(), *added.values()]) + 1)
        for entry, i in spec["model"]["vocab"].items():
            self.bytes_of[i] = entry.encode() if entry in added else bytes(letters[c] for c in entry)
        self.specials = {} if plain_specials else added
        self._special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self.fast = self._fast(spec, added)

    def _fast(self, spec: dict, added: dict):
        """The same vocabulary in tiktoken, or None where ids and merges are numbered apart."""
        kind, split, vocab = spec["model"], spec["pre_tokenizer"] or {}, spec["model"]["vocab"]
        simple = (kind["type"] == "BPE" and not kind.get("ignore_merges") and spec["normalizer"] is None
                  and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
                  and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or not t["special"] for t in spec["added_tokens"]))
        merges = [m.split(" ") if isinstance(m, str) else m for m in kind.get("merges", [])]
        if not simple or any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
            return None
        import tiktoken

        ranks = {self.bytes_of[i]: i for entry, i in vocab.items() if entry not in added}
        return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, without added special tokens, truncation or padding."""
        out: list = [None] * len(texts)
        slow = []
        for k, text in enumerate(texts):
            if self.fast and _SETTLED.fullmatch(text) and not _LONG_BLANKS.search(text):
                out[k] = self._encode_fast(text)
            else:
                slow.append(k)
        for k, e in zip(slow, self.tok.encode_batch([texts[k] for k in slow], add_special_tokens=False)):
            out[k] = e.ids
        return out

    def _encode_fast(self, text: str) -> list[int]:
        if not self._special or not self._special.search(text):
            return self.fast.encode_ordinary(text)
        ids, at = [], 0
        for m in self._special.finditer(text):
            ids += self.fast.encode_ordinary(text[at:m.start()]) + [self.specials[m[0]]]
            at = m.end()
        return ids + self.fast.encode_ordinary(text[at:])


def lots(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of batches with about ``LOT_CHARS`` characters, and their texts (null: empty)."""
    for b in batches:
        start, size, lot = 0, 0, []
        for k in range(b.num_rows):
            lot.append(b.column(column)[k].as_py() or "")
            size += len(lot[-1])
            if size >= LOT_CHARS:
                yield b.slice(start, k + 1 - start), lot
                start, size, lot = k + 1, 0, []
        if lot:
            yield b.slice(start), lot
