"""Suffix-array dedup over bytes by iterative interleave refinement.

Suffixes are sampled at anchors of 200 bytes (see ``repeats``). The scan of the texts gives shards: the sampled suffixes
of a quarter of a megabyte of text, sorted, with the bytes that each shares with the one before it and the bytes that
precede it (what a Burrows-Wheeler transform stores of a suffix). A task then merges the shards of its anchors as such
transforms are merged. It starts from the interleave in which each group is one interval, shard after shard, and refines
it by blocks of bytes. A round looks only at intervals that hold suffixes of several shards, and puts these in the order
of the next block; as suffixes of one shard are in order already, that is a stable merge of runs. Where blocks differ, the
interval is split. Intervals of one shard are settled: their order and their common prefixes are the shard's. No suffix
is sorted anew or compared from its start. The round and the byte at which neighbours of different shards part is their
common prefix, so common prefixes and repeated intervals come with the merge. What precedes the suffixes is merged in the
same way, and decides how far a repeat reaches to the left.

A byte is removed if a stretch of ``window`` bytes around it also starts anywhere else, the same document included.

Defined results: null texts are empty; rows with a null id count as documents like others; a text of fewer than
``window`` bytes loses nothing; repeated rows are repeats of each other; a table without rows gives none; other columns
are ignored. Texts are taken whole: a very long one is hashed by the task that reads it, and what it shares is shuffled
suffix by suffix.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import repeats

BLOCK = 7  #: bytes of a round; with the end of the text as a value of its own, each takes nine bits


def interleave(group: np.ndarray, ahead: np.ndarray, shard: np.ndarray, place: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The merged order of suffixes by group and bytes ahead, and how many bytes each shares with the one before (-1 at a group's start).

    Bytes are given plus one, 0 is the end of the text. ``place`` is a suffix's place in its shard, ``same`` what it shares
    with the one before it there.
    """
    n, width = ahead.shape
    order = np.lexsort((place, shard, group))
    starts = np.concatenate([[True], group[order[1:]] != group[order[:-1]]])
    # until a round parts them, neighbours of one shard share what their shard says, others all
    inside = np.concatenate([[False], shard[order[1:]] == shard[order[:-1]]]) & ~starts
    shared = np.where(starts, -1, np.where(inside, same[order], width))
    mixed = np.flatnonzero(_of_several(starts, shard[order]))
    bits = np.uint64(9) * np.arange(BLOCK - 1, -1, -1, dtype=np.uint64)
    for at in range(0, width, BLOCK):
        if not len(mixed):
            break
        interval = np.cumsum(starts)[mixed]
        part = ahead[order[mixed], at : at + BLOCK].astype(np.uint64)
        key = (part << bits[: part.shape[1]]).sum(axis=1, dtype=np.uint64)
        moved = np.lexsort((key, interval))  # stable, so each shard's suffixes keep their order
        order[mixed] = order[mixed[moved]]
        part, key = part[moved], key[moved]
        differ = np.flatnonzero((key[1:] != key[:-1]) & (interval[1:] == interval[:-1])) + 1
        split = mixed[differ]
        starts[split] = True
        shared[split] = at + (part[differ] != part[differ - 1]).argmax(axis=1)
        now = shard[order]
        met = mixed[1:][(interval[1:] == interval[:-1]) & (key[1:] == key[:-1])]  # still one interval
        shared[met] = np.where(now[met] == now[met - 1], same[order[met]], width)
        mixed = mixed[_of_several(starts, now)[mixed]]
    return order, shared


def _of_several(starts: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """For each place, whether its interval holds suffixes of more than one shard."""
    begins = np.flatnonzero(starts)
    changed = np.concatenate([[False], shard[1:] != shard[:-1]]) & ~starts
    return np.repeat(np.logical_or.reduceat(changed, begins), np.diff(np.append(begins, len(starts)))) if len(starts) else starts


def sort_shard(group: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of a shard's own suffixes, and what neighbours share: a merge of as many shards as there are suffixes."""
    each = np.arange(len(group))
    return interleave(group, ahead, each, np.zeros_like(each), np.zeros_like(each))


def remove_repeats(docs: DataFrame, window: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n``, ``n_removed``, ``n_spans``, ``digest``, ``spans``; units are bytes."""
    return repeats.find(docs, repeats.Kind(window, max(2, window // 2), words=False, ordered=False, shard=sort_shard), interleave, id_col, text_col)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", F.col("digest").alias("kept_sha256"))
