"""SHA-256 taken up where another process left it."""

from __future__ import annotations

import ctypes
import ctypes.util
import hashlib
import struct
from collections.abc import Iterable
from functools import lru_cache

BLOCK = 64
# The state before any byte (FIPS 180-4, 5.3.3).
START = bytes.fromhex("6a09e667bb67ae853c6ef372a54ff53a510e527f9b05688c1f83d9ab5be0cd19")


class _Context(ctypes.Structure):
    """OpenSSL's SHA256_CTX."""

    _fields_ = [
        ("h", ctypes.c_uint32 * 8),
        ("bits_low", ctypes.c_uint32),
        ("bits_high", ctypes.c_uint32),
        ("data", ctypes.c_uint32 * 16),
        ("held", ctypes.c_uint),
        ("digest_length", ctypes.c_uint),
    ]


def _advance(library: ctypes.CDLL, state: bytes, done: int, parts: Iterable[bytes], last: bool) -> bytes:
    if done % BLOCK:
        raise ValueError(f"{done} bytes are not whole blocks of {BLOCK}")
    bits = done * 8
    context = _Context(h=struct.unpack(">8I", state), bits_low=bits & 0xFFFFFFFF, bits_high=bits >> 32, digest_length=32)
    for part in parts:
        library.SHA256_Update(ctypes.byref(context), ctypes.c_char_p(part), ctypes.c_size_t(len(part)))
    if last:
        digest = ctypes.create_string_buffer(32)
        library.SHA256_Final(digest, ctypes.byref(context))
        return digest.raw
    if context.held:
        raise ValueError(f"only the last part may end inside a block of {BLOCK} bytes")
    return struct.pack(">8I", *context.h)


@lru_cache(1)
def _library() -> ctypes.CDLL | None:
    """The OpenSSL library whose state can be set, tried on a known text; None where there is none."""
    text = b"tabloom" * 64
    try:
        library = ctypes.CDLL(ctypes.util.find_library("crypto"))
        half = _advance(library, START, 0, [text[:BLOCK]], False)
        right = _advance(library, half, BLOCK, [text[BLOCK:]], True) == hashlib.sha256(text).digest()
    except (OSError, AttributeError):
        return None
    return library if right else None


def available() -> bool:
    return _library() is not None


def advance(state: bytes, done: int, parts: Iterable[bytes], last: bool) -> bytes:
    """The state (32 bytes) after `parts`, which follow the `done` bytes behind `state`; the digest after the last ones.

    All parts but the last ones together fill whole blocks.
    """
    library = _library()
    if library is None:
        raise RuntimeError("no OpenSSL library with SHA256_Update was found")
    return _advance(library, state, done, parts, last)
