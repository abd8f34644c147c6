"""Token ids of a byte-level BPE tokenizer file, by the fastest library that gives the same ids."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np

from wardloom.llm.common import sent_to_tasks

# fixed value: the pattern that byte-level pre-tokenization splits by
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def token_bytes(file: str) -> list[bytes]:
    """The bytes of every id of a byte-level ``tokenizer.json``; none for ids that are not in its vocabulary."""
    letters, vocab = _byte_letters(), json.loads(file)["model"]["vocab"]
    found = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        found[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
    return found


def encoder(file: str, plain: bool = False) -> Callable[[str], np.ndarray]:
    """From the text of a ``tokenizer.json`` to ids without special tokens added, as ``tokenizers`` gives them.

    With ``plain`` the strings of special tokens inside a text are ordinary text.

    If the file is plain byte-level BPE whose ids are the merges' order, ``tiktoken`` computes the same ids several times faster; texts that hold
    the string of an added token, and all texts for any other file, go through ``tokenizers``.
    """
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(file)
    whole.encode_special_tokens = plain
    described = json.loads(file)
    model, before = described["model"], described.get("pre_tokenizer") or {}
    added = [t["content"] for t in described.get("added_tokens", ())]
    letters = _byte_letters()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", ())]
    usual = (
        model.get("type") == "BPE"
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and described.get("normalizer") is None
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
    )

    def slowly(text: str) -> np.ndarray:
        return np.array(whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    if not usual:
        return slowly
    ranks = {bytes(letters[c] for c in piece): i for piece, i in model["vocab"].items() if piece not in added}
    fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def quickly(text: str) -> np.ndarray:
        if not plain and any(a in text for a in added):
            return slowly(text)
        return np.array(fast.encode_to_numpy(text, disallowed_special=()), dtype=np.uint32)

    return quickly


sent_to_tasks(__name__)
