"""Physical types of branches and what they become in NumPy, Arrow and Spark."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T


@dataclass(frozen=True)
class Primitive:
    name: str  # as in the column metadata
    suffix: str  # of a branch title, after the slash
    disk: str  # big-endian NumPy type
    memory: str  # native NumPy type handed to Spark
    arrow: pa.DataType
    spark: T.DataType
    cpp: str  # element name in vector<...>

    @property
    def width(self) -> int:
        return np.dtype(self.disk).itemsize


# Fixed values of the format: name, title suffix, disk type, memory type, Arrow and Spark type, C++ name.
# Spark has no unsigned types: up to 32 bits they widen, 64 bits keep their bits.
PRIMITIVES = {
    p.name: p
    for p in (
        Primitive("bool", "O", "?", "?", pa.bool_(), T.BooleanType(), "bool"),
        Primitive("char", "B", ">i1", "i1", pa.int8(), T.ByteType(), "char"),
        Primitive("uchar", "b", ">u1", "i2", pa.int16(), T.ShortType(), "unsigned char"),
        Primitive("short", "S", ">i2", "i2", pa.int16(), T.ShortType(), "short"),
        Primitive("ushort", "s", ">u2", "i4", pa.int32(), T.IntegerType(), "unsigned short"),
        Primitive("int", "I", ">i4", "i4", pa.int32(), T.IntegerType(), "int"),
        Primitive("uint", "i", ">u4", "i8", pa.int64(), T.LongType(), "unsigned int"),
        Primitive("long", "L", ">i8", "i8", pa.int64(), T.LongType(), "long"),
        Primitive("ulong", "l", ">i8", "i8", pa.int64(), T.LongType(), "unsigned long"),
        Primitive("float", "F", ">f4", "f4", pa.float32(), T.FloatType(), "float"),
        Primitive("double", "D", ">f8", "f8", pa.float64(), T.DoubleType(), "double"),
    )
}
BY_SUFFIX = {p.suffix: p for p in PRIMITIVES.values()}
BY_CPP = {p.cpp: p for p in PRIMITIVES.values()} | {
    alias: PRIMITIVES[name]
    for alias, name in {"signed char": "char", "Bool_t": "bool", "Char_t": "char", "UChar_t": "uchar", "Short_t": "short", "UShort_t": "ushort", "Int_t": "int", "UInt_t": "uint", "Long64_t": "long", "ULong64_t": "ulong", "Float_t": "float", "Double_t": "double", "long long": "long", "unsigned long long": "ulong", "unsigned": "uint"}.items()
}
#: Leaf class -> type, and its unsigned twin.
BY_LEAF = {"TLeafO": ("bool", "bool"), "TLeafB": ("char", "uchar"), "TLeafS": ("short", "ushort"), "TLeafI": ("int", "uint"), "TLeafL": ("long", "ulong"), "TLeafF": ("float", "float"), "TLeafD": ("double", "double")}
#: Streamer element codes of TLeafElement.
BY_CODE = {1: "char", 2: "short", 3: "int", 4: "long", 5: "float", 6: "uint", 8: "double", 11: "uchar", 12: "ushort", 13: "uint", 14: "ulong", 16: "long", 17: "ulong", 18: "bool"}


class UnsupportedBranch(Exception):
    """A branch of a type outside the data model; its column is left out."""
