"""Substring dedup with prefix-partitioned suffix trees over words.

Suffixes are sampled at anchors of 25 words (see ``repeats``), and the anchor is the prefix that partitions them: all
suffixes of a group share it, and a group that is too large to hold gets longer prefixes. Within a chunk of groups the
suffixes are sorted, which with the number of words that neighbours share is the group's suffix tree: the nodes of a
depth are the runs of neighbours that share that many words. Nodes of depth 25 to 50, with as many words left of the
anchor as are missing to 50, are the repeated windows; the deepest of them give the maximal repeat around the anchor.

A word is removed if a window of ``window`` words around it also starts in a document with a smaller id.

Defined results: null texts have no words; rows with a null id are no document that others repeat, and keep all their
words; rows that share an id are never repeats of each other; equal texts keep their words in the rows with the
smallest id; a table without rows gives none; other columns are ignored. Texts are taken whole: a very long one is cut into
words by the task that reads it, and what it shares is shuffled suffix by suffix.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import repeats


def suffix_tree(group: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of suffixes by group and units ahead, and how many units each shares with the one before (-1 at a group's start)."""
    order = np.lexsort((*ahead.T[::-1], group))
    same = ahead[order[1:]] == ahead[order[:-1]]
    shared = np.where(same.all(axis=1), ahead.shape[1], same.argmin(axis=1)) if ahead.shape[1] else np.zeros(len(order) - 1, np.int64)
    shared = np.where(group[order[1:]] == group[order[:-1]], shared, -1)
    return order, np.concatenate([[-1], shared])


def remove_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n``, ``n_removed``, ``n_spans``, ``digest``, ``spans``; units are words."""
    kind = repeats.Kind(window, max(2, window // 2), words=True, ordered=True)
    return repeats.find(docs, kind, lambda group, ahead, *_: suffix_tree(group, ahead), id_col, text_col)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", F.col("n").alias("n_words"), "n_removed", F.col("digest").alias("kept_sha256"))
