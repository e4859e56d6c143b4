"""Byte-level BPE from a public tokenizer file.

:class:`Encoder` reads the ``.json`` vocabulary of the tokenizers library.
Where the file is a plain byte-level BPE (every merge makes the next id, no
normaliser, prefix space or post-processor) the ids are computed by tiktoken
over the same merges, which gives the same ids several times faster; any other
file is refused.  Text that tiktoken cannot split (runs of about a million
white-space characters) is encoded by the library.  Added tokens inside a text
become their special ids, as the library does by default.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from tripcast.llm.common import held

# Fixed value: the split pattern of byte-level BPE (public_tokenizers.PATTERN).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies print each byte as one visible character: the
    printable Latin-1 bytes as themselves, the others from U+0100 upwards."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return out | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """ids of a text, byte length and bytes of an id."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec.get("added_tokens") or []
        self.specials = {a["content"]: a["id"] for a in added}
        byte = _byte_of_char()
        vocab = model["vocab"]
        ranks = {}
        for token, i in vocab.items():
            if token not in self.specials:
                ranks[bytes(byte[c] for c in token)] = i
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        pre = spec.get("pre_tokenizer") or {}
        self.plain = (
            model["type"] == "BPE" and not spec.get("normalizer") and not spec.get("post_processor")
            and not model.get("dropout") and not model.get("ignore_merges")
            and not model.get("end_of_word_suffix") and not model.get("continuing_subword_prefix")
            and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and all(not (a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"]) for a in added)
            and [vocab[a + b] for a, b in merges] == list(range(256, 256 + len(merges))))
        if not self.plain:
            raise ValueError(f"{path} is not a plain byte-level BPE")
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.specials)
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in ranks.items():
            self.bytes_of[i] = token
        for text, i in self.specials.items():
            self.bytes_of[i] = text.encode()
        self.length_of = np.array([len(b) for b in self.bytes_of], np.int64)
        self.decimal_of = [str(i) for i in range(size)]
        self.id_type = np.uint16 if size <= 65536 else np.uint32

    def encode(self, text: str) -> list[int]:
        try:
            return self.fast.encode(text, allowed_special="all", disallowed_special=())
        except ValueError:  # a run of white space too long for its pattern matcher
            return library(self.path).encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")


def encoder(path: str) -> Encoder:
    return held(("encoder", path), lambda: Encoder(path))


@functools.lru_cache(maxsize=1)
def library(path: str) -> Tokenizer:
    """The tokenizers library itself, without truncation or padding."""
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


# Stable cuts: a match of the pattern ends there whatever comes before, and the next one starts there whatever follows.
# - Before ASCII white space that follows anything else: a match holds white space only as its first character or as a
#   whole run.  Characters beyond ASCII count unless they are white space themselves.
# - Between a letter of a script written without spaces and CJK punctuation, either way round: a match of letters holds
#   no punctuation and a match of punctuation no letter.  Special tokens are ASCII and hold neither.
# Fixed values in UTF-8: white space beyond ASCII is U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F
# and U+3000; letters are U+3041-U+3096, U+30A1-U+30FA and U+5000-U+8FFF; punctuation is U+3001, U+3002, U+3008-U+3011,
# U+FF01, U+FF08, U+FF09, U+FF0C, U+FF1A, U+FF1B and U+FF1F.
_NO_SPACE = (rb"(?<!\xc2[\x85\xa0])(?<!\xe1\x9a\x80)(?<!\xe2\x80[\x80-\x8a\xa8\xa9\xaf])(?<!\xe2\x81\x9f)(?<!\xe3\x80\x80)")
_LETTER = rb"(?:[\xe5-\xe8][\x80-\xbf][\x80-\xbf]|\xe3\x81[\x81-\xbf]|\xe3\x82[\x80-\x96\xa1-\xbf]|\xe3\x83[\x80-\xba])"
_MARK = rb"(?:\xe3\x80[\x81\x82\x88-\x91]|\xef\xbc[\x81\x88\x89\x8c\x9a\x9b\x9f])"
STABLE = re.compile(rb"(?<=[!-~\x80-\xbf])" + _NO_SPACE + rb"(?=[\t-\r ])|(?<=" + _LETTER + rb")(?=" + _MARK + rb")|(?<="
                    + _MARK + rb")(?=" + _LETTER + rb")")
