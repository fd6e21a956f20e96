"""Best-N items per user by dot product or cosine, without building user x item rows.

Items are sorted by the length of their vectors and cut into chunks of bounded size, the
longest first. Users are dealt to tasks, a bounded number to each, and every chunk goes to
every task, one after the other, all in one plan. A task keeps the best rows of its users
so far. No item of a chunk can score higher with a user than the user's length times the
chunk's greatest (or 1 with cosines), so a user whose list is full and better than that is
left out of the chunk, and only users who are not are multiplied.

A user has seen some items, which must not be recommended. Each user therefore
keeps its best n + (number of seen items) rows: at most that many of them can be
seen ones, so removing them by an anti-join still leaves the true best n.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators.windows import sorted_positions, top_n_per_key
from marketloom.session import materialize, python_partitions

CHUNK_CELLS = 500_000  # vector entries of a chunk
DENSE_CELLS = 4_000_000  # a chunk is a full matrix up to that many
TASK_USERS = 20_000
SCORE_DECIMALS = 9  # scores closer than this are ties and are ordered by item


def pack_vectors(long: DataFrame, key: str) -> DataFrame:
    """(key, dim, value) rows to one (key, dims, vals, norm) row per key."""
    packed = long.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("_v"),
        F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"),
    )
    return packed.select(key, F.col("_v.dim").alias("dims"), F.col("_v.value").alias("vals"), "norm")


def _chunks(items: DataFrame, item: str, chunk_cells: int) -> DataFrame:
    """(chunk, top, payload): items by falling norm, ``top`` being a chunk's greatest, the payload its vectors as arrays."""
    n, cells = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("dims")), F.lit(0))).first()
    rows = max(1, chunk_cells * n // max(cells, 1))
    placed = sorted_positions(items.select(item, "dims", "vals", "norm", (-F.col("norm")).alias("_down")), "_down", item)
    numbered = placed.withColumn("chunk", F.floor(F.col("position") / rows))
    dense_cells = min(DENSE_CELLS, 8 * CHUNK_CELLS)

    def pack(key, local):
        import numpy as np
        import pandas as pd

        lengths = local["dims"].map(len).to_numpy()
        flat = np.concatenate(local["dims"].to_list()) if lengths.sum() else np.array([])
        weights = np.concatenate(local["vals"].to_list()) if lengths.sum() else np.array([])
        vocabulary, codes = np.unique(flat, return_inverse=True)
        row = np.repeat(np.arange(len(local)), lengths)
        columns = values = dense = None
        if len(vocabulary) * len(local) <= dense_cells:
            dense = np.zeros((len(vocabulary), len(local)))
            dense[codes, row] = weights
        else:
            width = int(lengths.max())
            place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            columns = np.full((len(local), width), len(vocabulary))  # the padding column stays zero
            values = np.zeros((len(local), width))
            columns[row, place] = codes
            values[row, place] = weights
        norms = local["norm"].to_numpy(dtype="float64")
        sent = {"ids": local[item].to_numpy(), "vocabulary": vocabulary, "columns": columns, "values": values, "norms": norms, "dense": dense}
        return pd.DataFrame({"chunk": [key[0]], "top": [norms.max()], "payload": [pickle.dumps(sent, 5)]})

    return materialize(numbered.groupBy("chunk").applyInPandas(pack, "chunk BIGINT, top DOUBLE, payload BINARY"), "chunks")


def _kernel(item: str, user: str, cosine: bool, n: int, summary: bool):
    """Scores the users of a task with one chunk after the other; nested so that it is shipped to the workers by value."""
    decimals = SCORE_DECIMALS

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        class Task:
            def __init__(self):
                self.parts, self.users = [], None

            def ready(self):
                self.users = pd.concat(self.parts, ignore_index=True)
                self.norms = self.users["norm"].to_numpy(dtype="float64")
                count = len(self.users)
                self.read = np.zeros(count, dtype="int64")
                if summary:
                    self.items, self.best, self.total = 0, np.full(count, -np.inf), np.zeros(count)
                    return
                self.keep = self.users["seen"].to_numpy(dtype="int64") + n
                self.floor = np.full(count, -np.inf)  # score of the last row of a full list
                self.ids, self.scores = [None] * count, [np.zeros(0)] * count

            def scores_of(self, rows, data, vocabulary):
                block = self.users.iloc[rows]
                lengths = block["dims"].map(len).to_numpy()
                at_user = np.repeat(np.arange(len(block)), lengths)
                flat = np.concatenate(block["dims"].to_list()) if lengths.sum() else np.array([])
                weights = np.concatenate(block["vals"].to_list()) if lengths.sum() else np.array([])
                at = vocabulary.get_indexer(flat)
                known = at >= 0
                full = np.zeros((len(block), len(vocabulary) + 1))
                full[at_user[known], at[known]] = weights[known]
                if data["dense"] is not None:
                    scores = full[:, :-1] @ data["dense"]
                else:
                    scores = np.zeros((len(block), len(data["ids"])))
                    for j in range(data["columns"].shape[1]):
                        scores += full[:, data["columns"][:, j]] * data["values"][:, j]
                if cosine:
                    scale = self.norms[rows][:, None] * data["norms"][None, :]
                    scores = np.divide(scores, scale, out=np.zeros_like(scores), where=scale > 0)
                return np.round(scores, decimals)

            def score(self, data, top):
                if self.users is None:
                    self.ready()
                vocabulary, ids = pd.Index(data["vocabulary"]), data["ids"]
                if summary:
                    rows = np.arange(len(self.users))
                    self.items += len(ids)
                else:
                    bound = np.ones(len(self.users)) if cosine else self.norms * top
                    # rounding may lift a score a little above the bound
                    rows = np.flatnonzero(bound + 10.0**-decimals * (1 + np.abs(bound)) >= self.floor)
                self.read[rows] += 1
                at_once = max(1, 500_000 // max(len(ids), len(vocabulary), 1))
                for start in range(0, len(rows), at_once):
                    part = rows[start : start + at_once]
                    scores = self.scores_of(part, data, vocabulary)
                    if summary:
                        self.best[part] = np.maximum(self.best[part], scores.max(axis=1))
                        self.total[part] += scores.sum(axis=1)
                        continue
                    good = scores >= self.floor[part][:, None]
                    for u, row, mask in zip(part[good.any(axis=1)], scores[good.any(axis=1)], good[good.any(axis=1)]):
                        k = self.keep[u]
                        here = np.flatnonzero(mask)
                        if len(here) > k:
                            least = np.partition(row[here], len(here) - k)[len(here) - k]
                            here = here[row[here] >= least]
                        own = ids[here] if self.ids[u] is None else np.concatenate([self.ids[u], ids[here]])
                        both = np.concatenate([self.scores[u], row[here]])
                        order = np.lexsort((own, -both))[:k]
                        self.ids[u], self.scores[u] = own[order], both[order]
                        if len(order) == k:
                            self.floor[u] = both[order[-1]]

            def finish(self):
                if self.users is None:  # no chunk, no item
                    return
                names = self.users[user].to_numpy()
                if summary:
                    yield pd.DataFrame({user: names, "n_items": self.items, "best_score": self.best, "total_score": self.total})
                    return
                for start in range(0, len(names), 1000):
                    some = [u for u in range(start, min(start + 1000, len(names))) if self.ids[u] is not None]
                    if some:
                        counts = [len(self.ids[u]) for u in some]
                        yield pd.DataFrame(
                            {
                                user: np.repeat(names[some], counts),
                                item: np.concatenate([self.ids[u] for u in some]),
                                "score": np.concatenate([self.scores[u] for u in some]),
                                "chunks_read": np.repeat(self.read[some], counts),
                            }
                        )

        number, task = None, None
        for batch in batches:
            for at, rows in batch.groupby("_task", sort=False):
                if at != number:
                    if task:
                        yield from task.finish()
                    number, task = at, Task()
                mine = rows[rows["chunk"] < 0]
                if len(mine):
                    task.parts.append(mine[[user, "dims", "vals", "norm", "seen"]])
                for top, payload in rows.loc[rows["chunk"] >= 0, ["top", "payload"]].itertuples(index=False):
                    task.score(pickle.loads(payload), top)
        if task:
            yield from task.finish()

    return run


def _score(users: DataFrame, items: DataFrame, user: str, item: str, cosine: bool, n: int, summary: bool, schema: str, chunk_cells: int) -> DataFrame:
    chunks = _chunks(items, item, chunk_cells)
    tasks = python_partitions(users.sparkSession, users.count(), TASK_USERS)
    own = users.select(F.pmod(F.xxhash64(user), F.lit(tasks)).alias("_task"), F.lit(-1).cast("bigint").alias("chunk"), user, "dims", "vals", "norm", "seen")
    # a chunk only goes where there are users
    asked = own.select("_task").distinct().agg(F.collect_set("_task").alias("_tasks"))
    sent = chunks.withColumn("_task", F.explode(asked.scalar()))
    both = own.unionByName(sent, allowMissingColumns=True).repartitionById(tasks, F.col("_task").cast("int")).sortWithinPartitions("_task", "chunk")
    return both.mapInPandas(_kernel(item, user, cosine, n, summary), schema)


def _types(users: DataFrame, user: str, items: DataFrame, item: str) -> tuple[str, str]:
    return users.schema[user].dataType.simpleString(), items.schema[item].dataType.simpleString()


def recommend(
    users: DataFrame,
    items: DataFrame,
    seen: DataFrame,
    n: int,
    user: str = "user_id",
    item: str = "product_id",
    cosine: bool = False,
    chunk_cells: int = CHUNK_CELLS,
    with_chunks: bool = False,
) -> DataFrame:
    """(user, item, score, rank) of the best ``n`` unseen items of every user.

    ``users`` and ``items`` are packed vectors, ``seen`` distinct (user, item) pairs.
    ``with_chunks`` adds ``chunks_read``, the number of item chunks that the user was scored with.
    """
    known = seen.join(items.select(item), item, "left_semi")
    counts = known.groupBy(user).agg(F.count(F.lit(1)).alias("seen"))
    ready = materialize(users.join(counts, user, "left").withColumn("seen", F.coalesce("seen", F.lit(0))), "users")
    user_type, item_type = _types(users, user, items, item)
    schema = f"`{user}` {user_type}, `{item}` {item_type}, score DOUBLE, chunks_read BIGINT"
    best = _score(ready, items, user, item, cosine, n, False, schema, chunk_cells)
    unseen = best.join(known, [user, item], "left_anti")
    ranked = top_n_per_key(unseen, user, "score", item, n)
    return ranked if with_chunks else ranked.drop("chunks_read")


def score_summary(
    users: DataFrame,
    items: DataFrame,
    user: str = "user_id",
    item: str = "product_id",
    cosine: bool = False,
    chunk_cells: int = CHUNK_CELLS,
) -> DataFrame:
    """Per user over all items: how many were scored, the best and the mean score."""
    user_type, _ = _types(users, user, items, item)
    schema = f"`{user}` {user_type}, n_items BIGINT, best_score DOUBLE, total_score DOUBLE"
    ready = materialize(users.withColumn("seen", F.lit(0)), "users")
    parts = _score(ready, items, user, item, cosine, 0, True, schema, chunk_cells)
    return parts.select(user, "n_items", "best_score", (F.col("total_score") / F.col("n_items")).alias("mean_score"))
