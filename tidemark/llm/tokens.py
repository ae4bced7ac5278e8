"""The public byte-level tokenizer inside tasks."""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re

#: Texts with only these characters are split alike by every version of Unicode's classes, so both libraries must agree on
#: them. The others, and those that hold the special token's string or a very long word, go to the reference library.
PLAIN = re.compile(r"[\t\n\r -~¡-ſ–—‘-”…]*")
SPECIAL = "<|endoftext|>"
LONG_WORD = 2000


def tokenizer_path(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return path


def tokenizer_version(path: str | None = None) -> str:
    """Digest of the tokenizer: its file and what is asked of it."""
    with open(tokenizer_path(path), "rb") as f:
        return hashlib.sha256(f.read() + b"|add_special_tokens=False").hexdigest()


class Encoder:
    """Token ids as ``tokenizers`` gives them for the file, without added special tokens.

    The file's vocabulary also comes as ranks (the same name with .tiktoken); a faster library reads those. It is used
    for plain texts only, see PLAIN; without the ranks ``tokenizers`` encodes everything.
    """

    def __init__(self, path: str | None = None):
        self.path, self.plain = tokenizer_path(path), None
        ranks = os.path.splitext(self.path)[0] + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    @functools.cached_property
    def full(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def encode(self, text: str) -> list[int]:
        if self.plain is not None and PLAIN.fullmatch(text) and SPECIAL not in text:
            if len(text) < LONG_WORD or max(map(len, text.split()), default=0) < LONG_WORD:
                return self.plain.encode_ordinary(text)
        return self.full.encode(text, add_special_tokens=False).ids


@functools.cache
def encoder(path: str | None = None) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)
