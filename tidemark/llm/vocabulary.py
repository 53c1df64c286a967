"""Vocabularies of public tokenizers inside tasks. Files are named by a path and read there."""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

BYTE_BPE = "byte_bpe_50k.json"
MULTI_BPE = "byte_bpe_multi_50k.tiktoken"


def path(name: str) -> str:
    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary of a byte-level JSON file.

    Printable bytes stand for themselves, the others for the letters from 256 on, in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    letters = {chr(byte): byte for byte in printable}
    return letters | {chr(256 + i): byte for i, byte in enumerate(others)}


def read_ranks(file: str) -> dict[bytes, int]:
    """Bytes and id of each token, from a rank file or a byte-level BPE in JSON.

    In the JSON files the ids are in the order of the merges, as ranks are; added tokens are left
    out, as they are no result of merges.
    """
    if file.endswith(".json"):
        with open(file, encoding="utf-8") as opened:
            whole = json.load(opened)
        special = {token["content"] for token in whole["added_tokens"]}
        letters = _byte_letters()
        return {
            bytes(letters[letter] for letter in token): number
            for token, number in whole["model"]["vocab"].items()
            if token not in special
        }
    with open(file, "rb") as opened:
        lines = map(bytes.split, opened)
        return {base64.b64decode(token): int(rank) for token, rank in lines}


def added_tokens(file: str) -> dict[str, int]:
    """The tokens that a JSON file adds, which its library finds in the text before all merges."""
    if not file.endswith(".json"):
        return {}
    with open(file, encoding="utf-8") as opened:
        return {token["content"]: token["id"] for token in json.load(opened)["added_tokens"]}


@lru_cache(maxsize=2)
def encoding(file: str) -> tiktoken.Encoding:
    """The encoder, built once in each Python worker."""
    return tiktoken.Encoding(
        file,
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=read_ranks(file),
        special_tokens=added_tokens(file),
    )


def encoded(file: str, text: str) -> np.ndarray:
    """The ids of a text as little-endian unsigned 32-bit integers, added tokens as ordinary text."""
    return encoding(file).encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


def encoded_with_added(file: str, text: str) -> np.ndarray:
    """The same, with the file's added tokens found in the text, as the tokenizers library does."""
    return encoding(file).encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


@lru_cache(maxsize=2)
def token_bytes(file: str) -> list[bytes]:
    """The bytes of each id."""
    ranks = read_ranks(file)
    found = [b""] * (max(ranks.values()) + 1)
    for token, number in ranks.items():
        found[number] = token
    return found
