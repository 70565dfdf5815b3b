"""Encoded log bytes, built apart from the reader under test."""

import struct

import pyarrow as pa

BLOCK = 1000


def lz4(data: bytes) -> bytes:
    out = b""
    for start in range(0, len(data), BLOCK):
        block = data[start : start + BLOCK]
        packed = pa.Codec("lz4_raw").compress(block, asbytes=True)
        if len(packed) >= len(block):
            out += b"LZ4Block" + struct.pack("<BIII", 0x15, len(block), len(block), 0) + block
        else:
            out += b"LZ4Block" + struct.pack("<BIII", 0x25, len(packed), len(block), 0) + packed
    return out + b"LZ4Block" + struct.pack("<BIII", 0x15, 0, 0, 0)


def snappy(data: bytes) -> bytes:
    out = b"\x82SNAPPY\x00" + struct.pack(">ii", 1, 1)
    for start in range(0, len(data), BLOCK):
        packed = pa.Codec("snappy").compress(data[start : start + BLOCK], asbytes=True)
        out += struct.pack(">i", len(packed)) + packed
    return out


def zstd(data: bytes) -> bytes:
    return pa.Codec("zstd").compress(data, asbytes=True)


ENCODERS = {"": bytes, ".zstd": zstd, ".lz4": lz4, ".snappy": snappy}
