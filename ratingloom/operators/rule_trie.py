"""Rules fired by histories: antecedents in a trie by ascending item, which packed histories walk from the root.

A walk keeps the (user, node) pairs whose path the user has, all users of a step together. So its work is the antecedents
that users have and the children tried below them, and no row for (user, antecedent item) is made in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.session import materialise

RULES_PER_BLOCK = 200_000  # (antecedent, item) pairs, some 20 MB; a single block of them may be sent to every task
RATINGS_PER_BLOCK = 100_000
STEP = 1_000_000  # pairs expanded at once
SCHEMA = "user_id long, item_id long, score double"


class _Trie:
    """Nodes level by level, children of a node next to each other; rules (item, confidence) at the nodes they end in."""

    def __init__(self, antecedents: list[np.ndarray], items: np.ndarray, confidences: np.ndarray):
        self.items = np.unique(np.concatenate([*antecedents, np.zeros(0, np.int64)]))
        sizes = np.array([len(a) for a in antecedents], np.int64)
        padded = np.full((len(antecedents), int(sizes.max(initial=0))), -1, np.int64)
        padded[np.arange(padded.shape[1]) < sizes[:, None]] = np.searchsorted(self.items, np.concatenate([np.sort(a) for a in antecedents]))
        node = np.zeros(len(antecedents), np.int64)  # 0 is the root
        parents, labels, total = [np.zeros(1, np.int64)], [np.full(1, -1, np.int64)], 1
        for depth in range(padded.shape[1]):
            deeper = np.flatnonzero(sizes > depth)
            pairs, at = np.unique(np.column_stack([node[deeper], padded[deeper, depth]]), axis=0, return_inverse=True)
            node[deeper] = total + at.ravel()
            parents.append(pairs[:, 0])
            labels.append(pairs[:, 1])
            total += len(pairs)
        parent, self.label = np.concatenate(parents), np.concatenate(labels)
        # nodes are numbered by level and parent, so a node's children are a range
        self.first = np.searchsorted(parent[1:], np.arange(total)) + 1
        self.children = np.bincount(parent[1:], minlength=total)
        by = np.argsort(node, kind="stable")
        self.item, self.confidence = items[by], confidences[by]
        self.rule = np.searchsorted(node[by], np.arange(total))
        self.rules = np.bincount(node, minlength=total)


def _ranges(first: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, number) of all numbers of the rows' ranges, at most about STEP at a time."""
    total = np.concatenate([[0], np.cumsum(count)])
    lo = 0
    while lo < len(first):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + STEP, "right")) - 1)
        row = np.repeat(np.arange(lo, hi), count[lo:hi])
        yield row, np.arange(total[hi] - total[lo]) + np.repeat(first[lo:hi] - total[lo:hi] + total[lo], count[lo:hi])
        lo = hi


def _fire(trie: _Trie, users: np.ndarray, items: np.ndarray) -> Iterator[pa.RecordBatch]:
    names, code = np.unique(users, return_inverse=True)
    wanted = np.unique(trie.item)
    item_code = np.searchsorted(wanted, trie.item)
    order = np.argsort(code, kind="stable")
    code, items = code[order], items[order]
    width = max(len(trie.items), len(wanted), 1)
    for lo in range(0, len(names), max(1, min(256, STEP // width))):
        hi = min(len(names), lo + max(1, min(256, STEP // width)))
        a, b = np.searchsorted(code, (lo, hi))
        has, seen = np.zeros((hi - lo, len(trie.items)), bool), np.zeros((hi - lo, len(wanted)), bool)
        for known, held in ((trie.items, has), (wanted, seen)):
            if len(known):
                at = np.minimum(np.searchsorted(known, items[a:b]), len(known) - 1)
                right = known[at] == items[a:b]
                held[code[a:b][right] - lo, at[right]] = True
        best = np.full((hi - lo, len(wanted)), -np.inf)
        waiting = [(np.arange(hi - lo), np.zeros(hi - lo, np.int64))]
        while waiting:
            user, node = waiting.pop()
            for row, rule in _ranges(trie.rule[node], trie.rules[node]):
                u, i = user[row], item_code[rule]
                new = ~seen[u, i]
                np.maximum.at(best, (u[new], i[new]), trie.confidence[rule[new]])
            for row, child in _ranges(trie.first[node], trie.children[node]):
                down = has[user[row], trie.label[child]]
                if down.any():
                    waiting.append((user[row[down]], child[down]))
        u, i = np.nonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(names[lo + u]), pa.array(wanted[i]), pa.array(best[u, i])], ["user_id", "item_id", "score"])


def fired(seen: DataFrame, best: DataFrame) -> DataFrame:
    """user_id, item_id, score: highest confidence of a rule of ``best`` (antecedent, item_id, confidence) that fires.

    ``seen`` has the distinct (user_id, item_id). Rules are cut into blocks by the first item of their antecedent, users
    by their id; each block of rules meets each block of users once.
    """
    spark = seen.sparkSession
    seen = materialise(seen.select(F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id")), "seen")
    best = materialise(best.select(F.col("antecedent").cast("array<long>").alias("antecedent"), F.col("item_id").cast("long").alias("item_id"), "confidence"), "rules")
    rows, cores = seen.count(), spark.sparkContext.defaultParallelism
    user_blocks = max(1, -(-rows // RATINGS_PER_BLOCK), min(2 * cores, rows // 2_000))
    rule_blocks = max(1, -(-best.count() // RULES_PER_BLOCK))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    packed = lambda df, key: df.groupBy(key).agg(F.collect_list(F.struct(*[c for c in df.columns if c != key])).alias("_r"))
    left = packed(seen.withColumn("_ub", block("user_id", user_blocks)), "_ub").select("_ub", F.col("_r.user_id").alias("users"), F.col("_r.item_id").alias("items"))
    right = packed(best.withColumn("_rb", block(F.array_min("antecedent"), rule_blocks)), "_rb")
    right = right.select("_rb", F.col("_r.antecedent").alias("antecedents"), F.col("_r.item_id").alias("consequents"), F.col("_r.confidence").alias("confidences"))
    if rule_blocks == 1:  # at most about RULES_PER_BLOCK rules
        met = left.repartition(user_blocks, "_ub").join(F.broadcast(right))
    else:
        left = left.withColumn("_rb", F.explode(F.sequence(F.lit(0), F.lit(rule_blocks - 1))))
        right = right.withColumn("_ub", F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))))
        tasks = user_blocks * rule_blocks
        met = left.repartition(tasks, "_ub", "_rb").join(right.repartition(tasks, "_ub", "_rb").hint("merge"), ["_ub", "_rb"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                users, items, ants, cons, confs = (batch.column(c)[k].values for c in range(5))
                flat, at = ants.flatten().to_numpy(zero_copy_only=False), ants.offsets.to_numpy()
                trie = _Trie(np.split(flat, at[1:-1] - at[0]), cons.to_numpy(zero_copy_only=False), confs.to_numpy(zero_copy_only=False))
                yield from _fire(trie, users.to_numpy(zero_copy_only=False), items.to_numpy(zero_copy_only=False))

    found = met.select("users", "items", "antecedents", "consequents", "confidences").mapInArrow(work, SCHEMA)
    return found if rule_blocks == 1 else found.groupBy("user_id", "item_id").agg(F.max("score").alias("score"))
