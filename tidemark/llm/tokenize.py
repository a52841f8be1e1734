"""Token ids of whole texts, by a byte-level BPE file of the `tokenizers` library.

The vocabulary is read from that file. Texts of plain characters, on whose
classes all regular expression engines agree, are encoded by a faster engine
with the same vocabulary; any other text, any that holds the string of an added
token, and any that the faster engine gives up on (a run of some million blanks is more
than its regular expressions can go back over) goes to the library itself. Tests hold
the two against each other.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types

import numpy as np

#: Fixed value: how this kind of tokenizer cuts a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Anything but plain Latin characters.
UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")


def printable_bytes() -> dict[str, int]:
    """The characters that stand for bytes in the file: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """encode(texts) gives the ids of each text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte, special = printable_bytes(), {x["content"] for x in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.slow = re.compile("|".join([UNUSUAL.pattern, *map(re.escape, sorted(special))]))
        self.fast = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of_worker(cls, path: str) -> Encoder:
        """The one that this Python process holds; a reused worker keeps it from task to task."""
        held = sys.modules.setdefault("tidemark_worker_state", types.ModuleType("tidemark_worker_state")).__dict__
        if ("encoder", path) not in held:
            held["encoder", path] = cls(path)
        return held["encoder", path]

    def encode_one(self, text: str) -> bytes:
        if not self.slow.search(text):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
            except ValueError:
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.encode_one(t) for t in texts]
