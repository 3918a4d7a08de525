"""Which of many (hash, owner, place) rows have a hash that occurs more than once, in one shuffle.

Tasks first look for repeats among the rows of one piece of input: such rows need no partner elsewhere. They travel
under a number of their own, which spreads them evenly, and one row without an owner stands for their hash. So a hash,
however frequent, has one row for each piece at most. After the shuffle rows are sorted by hash and compared with their
neighbours as they stream by; no group is ever held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tillweave.llm.textwords import mix

SCHEMA = "hash long, owner long, place int"
_WITNESS = -1
_U = np.uint64


def keyed(hashes: np.ndarray, owners: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    """One piece's rows, with what it knows of repeats itself."""
    codes, distinct = pd.factorize(hashes)
    many = np.bincount(codes, minlength=len(distinct)) > 1
    known = many[codes]
    owners, places = owners.astype(np.int64), places.astype(np.int32)
    spread = mix(owners[known].view(_U) ^ mix(places[known].astype(_U)))
    none = np.zeros(int(many.sum()), np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([hashes[~known], spread, distinct[many]]).view(np.int64)),
            pa.array(np.concatenate([owners[~known], owners[known], none])),
            pa.array(np.concatenate([places[~known], -2 - places[known], none + _WITNESS]).astype(np.int32)),
        ],
        ["hash", "owner", "place"],
    )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, equal = None, False  # the last row so far, and whether it equals the one before
    for batch in batches:
        hashes, owners, places = (batch.column(i).to_numpy() for i in range(3))
        if not len(hashes):
            continue
        if held is not None:
            hashes, owners, places = (np.r_[x, y] for x, y in zip(held, (hashes, owners, places), strict=True))
        same = hashes[1:] == hashes[:-1]
        repeated = np.r_[equal, same]
        repeated[:-1] |= same
        held, equal = (hashes[-1:], owners[-1:], places[-1:]), bool(repeated[-1])
        yield _found(owners[:-1], places[:-1], repeated[:-1])
    if held is not None:
        yield _found(held[1], held[2], np.array([equal]))


def _found(owners: np.ndarray, places: np.ndarray, repeated: np.ndarray) -> pa.RecordBatch:
    real = (places >= 0) & repeated | (places < _WITNESS)
    places = np.where(places < _WITNESS, -2 - places, places)
    return pa.RecordBatch.from_arrays([pa.array(owners[real]), pa.array(places[real].astype(np.int32))], ["owner", "place"])


def repeated_places(rows: DataFrame) -> DataFrame:
    """(owner, place) of the rows, as ``keyed`` makes them, whose hash occurs more than once."""
    dealt = rows.repartition("hash").sortWithinPartitions("hash")
    return dealt.mapInArrow(_streamed, "owner long, place int")
