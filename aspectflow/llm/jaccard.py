"""N-gram Jaccard join with token-combination prefixes.

Tokens are a document's distinct word shingles; documents with equal sets are one class.  In an order that puts rare
tokens first, two sets that overlap enough share a token among the first few of each (the prefix); the first k shared
tokens lie in the prefix extended by k - 1.  So a rare token (in few classes) is indexed by itself, and a frequent one
only in combination with a second token of the extended prefix.  What meets in the index is verified on whole sets.

Counting in how many classes each token occurs is the heavy part, and goes by packed exchange: a chunk of documents sends
each range of tokens one compact row, and gets one row back with the tokens that others have too.  A document fewer than
three quarters of whose tokens occur elsewhere can't be linked and needs no index entry.

Verification works on candidate groups (connected through the index), cut into blocks of bounded size.  Inside one, a
search over posting lists reaches every class that is linked, each once, so copies by the thousand cost one visit each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectflow.functions.batches import give_back, giving_back
from aspectflow.llm.shingles import BATCH_BYTES, mix64, shingle_set, text_batches, word_hashes
from aspectflow.llm.stored import connected_components, stored
from aspectflow.session import arrow_batches

WIDTH = 5
PERCENT = 75
FREQUENT = 64            # a token of more classes than this is indexed in combinations of two
CHUNK_TOKENS = 1 << 20
CHUNK_DOCS = 1 << 16     # documents in a chunk are numbered in two bytes
NODE_BYTES = 6           # of a class's digest, enough to tell the classes that share a token apart
MEMBER_BYTES = 64 << 20  # candidate ids are broadcast up to this size, beyond it the texts are shuffled to them
BLOCK_TOKENS = 1 << 20

_U = np.uint64
PACKED = "range int, chunk binary, local binary, low binary, node binary, doc binary"
INDEXED = "doc_id long, text_id long, n_shingles long, node binary, keys array<long>"


def set_digest(tokens: np.ndarray) -> bytes:
    """16 bytes that identify a token set."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def least_overlap(n: int) -> int:
    """Fewest tokens that a set of n shares with any set it is linked with."""
    return -(-PERCENT * n // 100)


def index_keys(tokens: np.ndarray, classes: np.ndarray, n: int) -> np.ndarray:
    """Keys under which a class of ``n`` tokens is indexed; two linked classes have one in common.

    ``tokens`` are those that occur in other classes too (the rest can't be shared) and ``classes`` in how many.
    Rare tokens come first, ties by token.  With n - least_overlap(n) + 1 places in the prefix, tokens that occur
    nowhere else take the first ones.
    """
    places = n - least_overlap(n) + 1 - (n - len(tokens))
    if places <= 0:
        return np.empty(0, _U)
    order = np.lexsort((tokens, classes))
    tokens, often = tokens[order], classes[order] > FREQUENT
    first = int(np.argmax(often)) if often.any() else len(tokens)
    singles = tokens[: min(places, first)]
    if first >= places:
        return mix64(singles)
    if least_overlap(n) < 2:          # one shared token may be all there is
        return mix64(tokens[:places])
    # the first shared token, at a place in the prefix, and the second, at most one place beyond it
    a, b = np.triu_indices(min(len(tokens), places + 1) - first, 1)
    frequent = tokens[first: places + 1]
    return np.concatenate([mix64(singles), mix64(mix64(frequent[a]) * _U(0x9FB21C651E98DF25) + frequent[b])])


def _send(ranges: int):
    """Map documents to packed rows: per chunk one row of (document, low token bits) for every token range."""
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        docs: list[tuple[int | None, np.ndarray, int]] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal seq, held
            ids = np.array([d or 0 for d, _, _ in docs], "<i8")
            nulls = np.array([d is None for d, _, _ in docs], np.uint8)
            nodes = np.frombuffer(b"".join(set_digest(t) for _, t, _ in docs), np.uint8).reshape(-1, 16)
            sizes = np.array([len(t) for _, t, _ in docs], "<u4")
            texts = np.array([x for _, _, x in docs], "<i8")
            chunk = hashlib.blake2b(f"{part}/{seq}".encode() + ids.tobytes() + nodes.tobytes(), digest_size=16).digest()
            # equal sets are looked up once; the chunk's own row goes along to be met again on the way back
            one = np.unique(nodes.copy().view("V16").ravel(), return_index=True)[1]
            local = np.repeat(one.astype("<u4"), sizes[one])
            tokens = np.concatenate([docs[i][1] for i in one])
            order = np.argsort(tokens)
            local, tokens = local[order], tokens[order]
            cuts = np.searchsorted(range_of(tokens, ranges), np.arange(ranges + 1))
            low = low_bits(tokens)
            rows = [[int.from_bytes(chunk[:4], "little") % ranges, chunk, None, None, nodes.tobytes(),
                     ids.tobytes() + texts.tobytes() + sizes.tobytes() + nulls.tobytes()]]
            for r in range(ranges):
                lo, hi = cuts[r], cuts[r + 1]
                if hi > lo:
                    present, at = np.unique(local[lo:hi], return_inverse=True)
                    rows.append([r, chunk, at.astype("<u2").tobytes(), low[lo:hi].tobytes(),
                                 nodes[present, :NODE_BYTES].tobytes(), None])
                    rows[-1][2] = present.astype("<u2").tobytes() + rows[-1][2]
            docs.clear()
            seq, held = seq + 1, 0
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int32() if c == 0 else pa.binary())
                                               for c in range(6)], names=["range", "chunk", "local", "low", "node", "doc"])

        for batch in text_batches(batches):
            words, cut = word_hashes(batch["text"])
            for i, (doc_id, text_id) in enumerate(zip(batch["doc_id"].to_pylist(), batch["text_id"].to_pylist())):
                docs.append((doc_id, shingle_set(words[cut[i]:cut[i + 1]], WIDTH), text_id))
                held += len(docs[-1][1])
                if held >= CHUNK_TOKENS or len(docs) == CHUNK_DOCS:
                    yield close()
        if docs:
            yield close()
    return run


def range_of(tokens: np.ndarray, ranges: int) -> np.ndarray:
    """Token range of each token, by its high 32 bits; ascending in the token."""
    return ((tokens >> _U(32)) * _U(ranges) >> _U(32)).astype(np.int32)


def low_bits(tokens: np.ndarray) -> np.ndarray:
    """What tells tokens of one range apart: their low 40 bits as 5 bytes (a rare clash only makes a token look shared)."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]


def widened(packed: bytes, width: int) -> np.ndarray:
    """Numbers of ``width`` bytes each as 64-bit ones."""
    raw = np.frombuffer(packed, np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """For one token range: tell every chunk which of its tokens occur in other classes too, and in how many."""
    carried = pdf["low"].isna().to_numpy()
    out = [pdf.loc[carried, ["chunk", "local", "node", "doc"]].assign(token=None, classes=None)]
    asks = pdf[~carried]
    tokens, docs, nodes, ends = [], [], [], [0]
    for local, low, node in zip(asks["local"], asks["low"], asks["node"]):
        present = len(node) // NODE_BYTES
        number = np.frombuffer(local, "<u2")
        tokens.append(widened(low, 5))
        docs.append(number[:present][number[present:]])
        nodes.append(widened(node, NODE_BYTES)[number[present:]])
        ends.append(ends[-1] + len(docs[-1]))
    if tokens:
        token, doc, node = np.concatenate(tokens), np.concatenate(docs), np.concatenate(nodes)
        order = np.argsort(token, kind="stable")
        again = np.zeros(len(token), bool)
        equal = token[order][1:] == token[order][:-1]
        again[order[1:][equal]] = True
        again[order[:-1][equal]] = True
        at = np.flatnonzero(again)                        # tokens met more than once; how many distinct classes?
        at = at[np.lexsort((node[at], token[at]))]
        new_token = np.concatenate([[True], token[at][1:] != token[at][:-1]])[: len(at)]
        new_node = new_token | np.concatenate([[True], node[at][1:] != node[at][:-1]])[: len(at)]
        group = np.cumsum(new_token) - 1
        classes = np.bincount(group, weights=new_node).astype(np.int64)[group] if len(at) else np.empty(0, np.int64)
        keep = classes > 1
        at, classes = at[keep], classes[keep]
        back = np.argsort(at, kind="stable")
        at, classes = at[back], classes[back]
        cuts = np.searchsorted(at, ends)
        for i in range(len(asks)):
            mine = slice(cuts[i], cuts[i + 1])
            if cuts[i] < cuts[i + 1]:
                out.append(pd.DataFrame({
                    "chunk": [asks["chunk"].iloc[i]], "local": [doc[at[mine]].astype("<u2").tobytes()], "node": [None], "doc": [None],
                    "token": [token[at[mine]].astype("<u8").tobytes()],
                    "classes": [np.minimum(classes[mine], 0xFFFFFFFF).astype("<u4").tobytes()]}))
    give_back()
    return pd.concat(out)[["chunk", "local", "node", "doc", "token", "classes"]]


def _index(pdf: pd.DataFrame) -> pd.DataFrame:
    """For one chunk: its documents' classes and index keys, from all answers."""
    own = pdf[pdf["doc"].notna()].iloc[0]
    nodes = [own["node"][i:i + 16] for i in range(0, len(own["node"]), 16)]
    n = len(nodes)
    ids, texts = np.frombuffer(own["doc"], "<i8", n), np.frombuffer(own["doc"], "<i8", n, 8 * n)
    sizes, nulls = np.frombuffer(own["doc"], "<u4", n, 16 * n), np.frombuffer(own["doc"], np.uint8, n, 20 * n)
    answers = pdf[pdf["doc"].isna()]
    if answers.empty:
        answers = pd.DataFrame({"local": [b""], "token": [b""], "classes": [b""]})
    local = np.frombuffer(bytearray(b"".join(answers["local"])), "<u2")
    token = np.frombuffer(bytearray(b"".join(answers["token"])), "<u8")
    classes = np.frombuffer(bytearray(b"".join(answers["classes"])), "<u4")
    order = np.argsort(local, kind="stable")
    cuts = np.searchsorted(local[order], np.arange(n + 1))
    keys = []
    for i in range(n):
        at = order[cuts[i]:cuts[i + 1]]
        keys.append(index_keys(token[at], classes[at], int(sizes[i])).view(np.int64) if len(at) else np.empty(0, np.int64))
    return pd.DataFrame({"doc_id": pd.array([None if z else int(d) for d, z in zip(ids, nulls)], dtype="Int64"),
                         "text_id": texts, "n_shingles": sizes.astype(np.int64), "node": nodes, "keys": keys})


def linked_classes(nodes: list[bytes], sets: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links between token sets: every class once, joined to the first of its component.

    A search over posting lists: expanding a class counts, for those not yet reached, how many of its tokens they
    hold.  Postings are rebuilt without what has been reached whenever that has halved them.
    """
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    mine = [codes[e - n:e] for e, n in zip(ends, sizes)]
    left = np.ones(len(sets), bool)
    owner = np.repeat(np.arange(len(sets)), sizes)
    width = int(codes.max()) + 1

    def postings() -> tuple[np.ndarray, np.ndarray]:
        keep = left[owner]
        c, o = codes[keep], owner[keep]
        order = np.argsort(c, kind="stable")
        return np.searchsorted(c[order], np.arange(width + 1)), o[order]

    starts, holders = postings()
    remaining, out = len(sets), []
    for root in range(len(sets)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            lo, hi = starts[mine[at]], starts[mine[at] + 1]
            total = int((hi - lo).sum())
            if not total:
                continue
            skip = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo)
            common = np.bincount(holders[np.arange(total) + skip], minlength=len(sets))
            found = np.flatnonzero(left & (100 * common >= PERCENT * (sizes + sizes[at] - common)) & (common > 0))
            left[found] = False
            queue.extend(found.tolist())
            out.extend((nodes[root], nodes[f]) for f in found)
            if 2 * int(left.sum()) < remaining:
                remaining = int(left.sum())
                starts, holders = postings()
    return out


def indexed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, n_shingles, node, keys) of every document; ``node`` names its class."""
    ranges = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    answered = (docs.select("doc_id", "text", F.xxhash64("text").alias("text_id")).mapInArrow(_send(ranges), PACKED).groupBy("range")
                .applyInPandas(_answer, "chunk binary, local binary, node binary, doc binary, token binary, classes binary"))
    return answered.groupBy("chunk").applyInPandas(_index, INDEXED)


def joined(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links, its own included).

    Documents with no word (or null text) have 0 shingles and are linked with nothing.  Repeated rows are equal
    documents.  A null doc_id takes part and never becomes a component_id unless all of its component are null.
    An empty table gives an empty result; other columns are not looked at.
    """
    return headed(docs).select("doc_id", "n_shingles", F.col("head.doc_id").alias("component_id"))


def headed(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_id (a hash of the text), n_shingles, head: (doc_id, text_id) of its component's first row.

    First is the smallest doc_id, null behind all others, and of equal ones the smallest text_id; a document without
    words is its own head.
    """
    with arrow_batches(docs.sparkSession, BATCH_BYTES):     # the kernels cut batches to that size anyway
        index = stored(indexed(docs), "shingle_index")
    entries = index.select("node", F.explode("keys").alias("key"))
    least = entries.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least != most")
    edges = entries.join(least, "key").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    groups = stored(connected_components(edges), "candidate_groups")
    # one document of every class brings the class's tokens; groups are cut into blocks by tokens
    classes = (index.join(groups, "node").groupBy("node", "component")
               .agg(F.min(F.struct("doc_id", "n_shingles")).alias("d")).select("node", "component", "d.*"))
    sizes = (classes.groupBy("component").agg(F.ceil(F.sum("n_shingles") / BLOCK_TOKENS).cast("int").alias("nb")))
    blk = F.pmod(F.xxhash64("node"), F.col("nb")).cast("int")
    others = F.when(F.col("nb") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("nb") - 1), lambda x: x != blk))
    places = (classes.join(sizes, "component").withColumn("o", F.explode(others))
              .select(F.col("doc_id").alias("member"), "node", "component",
                      F.least("o", F.when(F.col("nb") == 1, 0).otherwise(blk)).alias("i"),
                      F.greatest("o", F.when(F.col("nb") == 1, 0).otherwise(blk)).alias("j")))

    @giving_back
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            words, cut = word_hashes(batch["text"])
            sets = [shingle_set(words[cut[i]:cut[i + 1]], WIDTH) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array([set_digest(s) for s in sets], pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "tokens"])

    wanted = classes.select(F.col("doc_id").alias("member")).distinct()
    if wanted.count() * 16 <= MEMBER_BYTES:
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("member")), "left_semi")
    sets = texts.mapInArrow(tokens, "node binary, tokens binary").dropDuplicates(["node"])

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        links = linked_classes(list(pdf["node"]), [np.frombuffer(t, "<u8") for t in pdf["tokens"]])
        if pdf["tokens"].map(len).sum() >= BLOCK_TOKENS:     # of 8 bytes each; many groups are small
            give_back()
        return pd.DataFrame(links, columns=["a", "b"])

    links = (places.drop("member").join(sets, "node").groupBy("component", "i", "j").applyInPandas(verify, "a binary, b binary"))
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        found = stored(connected_components(links), "components")
    named = index.join(found, "node", "left")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id"))
    # stored, so that the joins below read them by shuffles of their own, whose hot partitions Spark can split: a component
    # or a class may hold a third of all rows
    heads = stored(named.where("component is not null").groupBy("component").agg(first.alias("head")), "heads")
    if heads.count() * 64 <= MEMBER_BYTES:
        heads = F.broadcast(heads)
    alike = stored(index.where("n_shingles > 0").groupBy("node").agg(first.alias("first")), "class_heads")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id")
    return (named.join(heads, "component", "left").join(alike, "node", "left")
            .select("doc_id", "text_id", "n_shingles", F.when(F.col("n_shingles") == 0, own)
                    .otherwise(F.coalesce("head", "first")).alias("head")))
