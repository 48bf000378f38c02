"""The prefix trie of conversations, built as a burst trie.

Every conversation is a sequence of turn ids. Containers hold the sequences below one trie head;
a container that is too large bursts by its next turn id into smaller ones, and what all of its
sequences share becomes a chain of heads. The containers that remain are sorted by sequence and
swept once, which gives their nodes. Equal conversations are one sequence with a count, so no
number of copies makes a container burst.
"""
from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import cut

ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE_SCHEMA = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
               "saved_tokens long, ends_sha256 string")
WORDS = r"[^\x20\x09-\x0D]+"


# ---- sequences ----------------------------------------------------------------------------

def turn_lists(conversations: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """(c, turns): each conversation's turns in order, as structs (turn, id, words).

    The id is 128 bits of a SHA-256 of role and text. Turns are ordered by number, null first, and
    equal numbers by id; repeated rows are repeated turns. Null role or text counts as empty. Rows
    with a null key belong to no conversation. A task holds one conversation's ids, not its texts.
    """
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    return (conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("c"), F.struct(
            F.col(turn).cast("long").alias("turn"),
            F.unhex(F.substring(F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t).cast("binary"), 256), 1, 32)).alias("id"),
            F.regexp_count(t, F.lit(WORDS)).cast("long").alias("words")).alias("x"))
        .groupBy("c").agg(F.sort_array(F.collect_list("x")).alias("turns")))


def with_shared_heads(lists: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Each conversation c with its first h turns replaced by the first h of conversation
    ``c - c % group``, where h is the crc32 of c in decimal, modulo ``most``: all of them if there
    are fewer, none if there is no such conversation."""
    first = lists.where(F.col("c") % group == 0).select(F.col("c").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % most).cast("int")
    own = lists.withColumn("base", F.col("c") - F.col("c") % group).join(first, "base", "left")
    none = F.slice("turns", 1, 0)
    return own.select("c", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h),
                                    F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def _chain(batches):
    """Keys of all prefixes of each sequence: 128 bits that hash the turn ids so far."""
    for b in batches:
        keys = []
        for ids in b.column(1).to_pylist():
            k, ks = ROOT, []
            for x in ids:
                k = hashlib.blake2b(k + x, digest_size=16).digest()
                ks.append(k)
            keys.append(ks)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([k[-1] if k else ROOT for k in keys], pa.binary()), pa.array(keys, pa.list_(pa.binary())),
             b.column(2)], names=["c", "full", "keys", "words"])


SEQUENCE_SCHEMA = "full binary, c long, n long, ends string, keys array<binary>, words array<long>"


def _merge_pieces(batches):
    """Pieces of equal sequences stand together, by ascending ids: one row for each sequence, with
    the hash over all of its ids. Ids pass through; none are kept."""
    now, digest, row = None, None, None
    for b in batches:
        out = []
        cols = [b.column(i) for i in range(b.num_columns)]
        for i, full in enumerate(cols[0].to_pylist()):
            ids = cols[1][i].values.to_numpy()
            text = ",".join(map(str, ids.tolist())).encode()
            if full != now:
                if now is not None:
                    out.append((*row, digest.hexdigest()))
                now, digest = full, hashlib.sha256(text)
                row = [full, int(ids[0]), len(ids), cols[2][i].as_py(), cols[3][i].as_py()]
            else:
                digest.update(b"," + text)
                row[2] += len(ids)
        if out:
            yield _sequences(out)
    if now is not None:
        yield _sequences([(*row, digest.hexdigest())])


def _sequences(rows: list[tuple]) -> pa.RecordBatch:
    full, c, n, keys, words, ends = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(full, pa.binary()), pa.array(c, pa.int64()), pa.array(n, pa.int64()), pa.array(ends, pa.string()),
         pa.array(keys, pa.list_(pa.binary())), pa.array(words, pa.list_(pa.int64()))],
        names=["full", "c", "n", "ends", "keys", "words"])


def distinct_sequences(lists: DataFrame, ids_per_piece: int = 1 << 16) -> DataFrame:
    """One row for each distinct sequence: smallest member, number of members, the SHA-256 of their
    ids, prefix keys and words by turn.

    Members are first gathered in pieces of a range of ``ids_per_piece`` ids, then pieces are hashed
    in order; a sequence that a third of all conversations share streams through one task in pieces
    (the digest is defined over all ids in order) and is never held.
    """
    chained = lists.select("c", F.transform("turns", lambda x: x["id"]).alias("ids"),
                           F.transform("turns", lambda x: x["words"]).alias("words")).mapInArrow(
        _chain, "c long, full binary, keys array<binary>, words array<long>")
    pieces = chained.groupBy("full", F.floor(F.col("c") / ids_per_piece).alias("piece")).agg(
        F.sort_array(F.collect_list("c")).alias("ids"), F.any_value("keys").alias("keys"), F.any_value("words").alias("words"))
    return (pieces.repartition("full").sortWithinPartitions("full", "piece").select("full", "ids", "keys", "words")
            .mapInArrow(_merge_pieces, SEQUENCE_SCHEMA))


# ---- sweep of containers ------------------------------------------------------------------

class _Node:
    __slots__ = ("depth", "words", "low", "convs", "leaves", "saved", "ends", "kids")

    def __init__(self, depth: int, words: int):
        self.depth, self.words, self.ends = depth, words, NO_ENDS
        self.low, self.convs, self.leaves, self.saved = None, 0, 0, 0
        self.kids: list[tuple] = []

    def take(self, low: int, convs: int) -> None:
        self.low = low if self.low is None or low < self.low else self.low
        self.convs += convs


class Sweep:
    """Nodes of containers from their sorted sequences. Open nodes are those of the current path;
    a closed node waits for its parent's close, as it needs the parent's smallest member."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.path: list[_Node] = []
        self.at = None  # the container
        self.keys: list[bytes] = []
        self.top = 0
        self.above = None

    def _close(self) -> None:
        x = self.path.pop()
        if not x.kids:
            x.leaves = 1
        x.saved += (x.convs - 1) * x.words
        self.rows += [(low, depth, x.low, *rest, False, None) for low, depth, *rest in x.kids]
        row = (x.low, x.depth, x.convs, len(x.kids), x.leaves, x.saved, x.ends)
        if self.path:
            p = self.path[-1]
            p.take(x.low, x.convs)
            p.leaves += x.leaves
            p.saved += x.saved
            p.kids.append(row)
        else:
            self.rows.append((x.low, x.depth, self.above[0], *row[2:], True, self.above[1]))

    def add(self, container: bytes, top: int, above: tuple, keys: list[bytes], words: list[int], c: int, n: int, ends: str) -> None:
        """The next sequence; ``above`` is (smallest member, key) of the head over the container."""
        if container != self.at:
            self.finish()
            self.at, self.top, self.above, self.keys = container, top, above, []
            self.path = [_Node(top, words[top - 1] if top else 0)]
            same = top
        else:
            same, most = top, min(len(keys), len(self.keys))
            while same < most and keys[same] == self.keys[same]:
                same += 1
        while len(self.path) > same - top + 1:
            self._close()
        for depth in range(same + 1, len(keys) + 1):
            self.path.append(_Node(depth, words[depth - 1]))
        last = self.path[-1]
        last.ends = ends
        last.take(c, n)
        self.keys = keys

    def finish(self) -> None:
        while self.path:
            self._close()


def _sweep(batches):
    names = [x.split()[0] for x in NODE_SCHEMA.split(", ")] + ["top", "up"]
    kinds = [pa.int64()] * 7 + [pa.string(), pa.bool_(), pa.binary()]
    s = Sweep()

    def out():
        cols = zip(*s.rows) if s.rows else [[]] * len(names)
        b = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)
        s.rows = []
        return b
    for b in batches:
        cols = [b.column(i).to_pylist() for i in range(b.num_columns)]
        for k, d, low, up, keys, words, c, n, ends in zip(*cols):
            s.add(k, d, (low, up), keys, words, c, n, ends)
            if len(s.rows) > 20_000:
                yield out()
    s.finish()
    yield out()


# ---- trie ---------------------------------------------------------------------------------

def _common_depth(a: Column, b: Column) -> Column:
    """Turns that two sequences share: keys hash whole prefixes, so equal keys are a prefix."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda same: same))


def prefix_trie(lists: DataFrame, *, container_sequences: int = 512, container_turns: int = 1 << 14) -> DataFrame:
    """Every node of the trie of ``lists`` (from :func:`turn_lists`): conv_id (smallest member),
    depth, parent_conv_id (the parent's smallest member; root: null), n_convs (members), n_children,
    n_leaves (childless nodes of its subtree), saved_tokens (over the subtree, (members - 1) times
    the words of a node's last text) and ends_sha256 (of the ids of members that end there, ascending
    and joined by commas).

    A container bursts if it holds more than ``container_sequences`` distinct sequences or
    ``container_turns`` turns (a single sequence never does). A burst skips what all sequences share
    at once, so every burst splits and a long common beginning costs one round. Rounds end when no
    container is too large; each is a few jobs over the sequences that are still open, and the driver
    gets one count. Conversations without turns end at the root. Empty table: no rows.
    """
    seqs = cut(distinct_sequences(lists))
    nothing = F.lit(None)
    live = seqs.select(F.lit(ROOT).alias("k"), F.lit(0).alias("d"), nothing.cast("long").alias("low_above"),
                       nothing.cast("binary").alias("up"), "keys", "words", "c", "n", "ends")
    columns = live.columns
    kept, rounds = [], []
    while True:
        sizes = live.groupBy("k").agg(F.count(F.lit(1)).alias("m"), F.sum(F.size("keys") - F.col("d")).alias("t"))
        over = cut(sizes.where((F.col("m") > 1) & ((F.col("m") > container_sequences) | (F.col("t") > container_turns)))
                   .select("k", F.lit(True).alias("big")))
        if not over.count():
            kept.append(live)
            break
        # before the first burst all sequences are in the root's container
        marked = cut(live.join(over, "k", "left") if rounds else live.withColumn("big", F.lit(True)))
        kept.append(marked.where("big IS NULL").select(*columns))
        hot = marked.where("big")
        heads = hot.groupBy("k").agg(
            F.any_value("d").alias("d"), F.any_value("low_above").alias("low_above"), F.any_value("up").alias("up"),
            F.min("c").alias("low"), F.sum("n").alias("convs"), F.min("keys").alias("first"), F.max("keys").alias("last"),
            F.any_value("words").alias("words"))
        shared = _common_depth(F.col("first"), F.col("last"))
        heads = cut(heads.withColumn("shared", shared).drop("first", "last")
                    .withColumn("words", F.slice("words", F.lit(1), F.col("shared"))))
        below = hot.join(heads.select("k", "shared", "low"), "k")
        ended = below.where(F.size("keys") == F.col("shared")).select("k", "ends")  # one sequence of a head at most
        rounds.append(cut(heads.join(ended, "k", "left")))
        live = below.where(F.size("keys") > F.col("shared")).select(
            F.element_at("keys", F.col("shared") + 1).alias("k"), (F.col("shared") + 1).alias("d"), F.col("low").alias("low_above"),
            F.col("k").alias("up"), "keys", "words", "c", "n", "ends")

    containers = reduce(DataFrame.unionByName, kept)
    swept = (containers.select("k", "d", "low_above", "up", "keys", "words", "c", "n", "ends")
             .repartition("k").sortWithinPartitions("k", "keys").mapInArrow(_sweep, NODE_SCHEMA + ", top boolean, up binary"))
    if not rounds:
        return swept.drop("top", "up")
    swept = cut(swept)
    tops = swept.where("top AND up IS NOT NULL").select("up", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    nodes = [swept.drop("top", "up")]
    for heads in reversed(rounds):  # a head's totals come from the containers and heads under it
        under = tops.groupBy(F.col("up").alias("k")).agg(
            F.count(F.lit(1)).alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        chain = heads.join(under, "k").withColumn("depth", F.explode(F.sequence("d", "shared")))
        top_turn = F.greatest(F.col("depth"), F.lit(1))  # the root has no text
        own = F.aggregate(F.slice("words", top_turn, F.greatest(F.col("shared") - top_turn + 1, F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x)
        chain = cut(chain.select(
            F.col("low").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
            F.when(F.col("depth") == F.col("d"), F.col("low_above")).otherwise(F.col("low")).alias("parent_conv_id"),
            F.col("convs").alias("n_convs"), F.when(F.col("depth") == F.col("shared"), F.col("kids")).otherwise(1).alias("n_children"),
            F.col("leaves").alias("n_leaves"), (F.col("saved") + (F.col("convs") - 1) * own).alias("saved_tokens"),
            F.when(F.col("depth") == F.col("shared"), F.col("ends")).alias("ends"), (F.col("depth") == F.col("d")).alias("top"), "up"))
        nodes.append(chain.select(*[c.split()[0] for c in NODE_SCHEMA.split(", ")][:-1],
                                  F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")))
        tops = tops.unionByName(chain.where("top AND up IS NOT NULL").select(
            "up", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")))
    return reduce(DataFrame.unionByName, nodes)


#: The unsigned crc32 of a decimal number, bit by bit (3988292384 is its polynomial).
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
    list_transform(range(1, length(CAST(c AS VARCHAR)) + 1), lambda i: ascii(substr(CAST(c AS VARCHAR), CAST(i AS INTEGER), 1))::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                             lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

ORACLE = f"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(struct_pack(r := role, t := text) ORDER BY turn NULLS FIRST, sha256(concat(length(role), ':', role, text))) AS x
        FROM t GROUP BY c),
h AS (SELECT *, {_CRC} % 4 AS h FROM own),
s AS (SELECT h.c, list_concat(coalesce(b.x[1:h.h], []), h.x[h.h + 1:]) AS x FROM h LEFT JOIN own b ON b.c = h.c - h.c % 20),
p AS (SELECT c, len(x) AS n, d, x[1:d] AS p FROM s, unnest(range(0, len(x) + 1)) AS u(d)),
n AS (SELECT p, d, min(c) AS c, count(*) AS m, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d) AS ends,
             (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(p[d].t, '[^\\x20\\x09-\\x0D]+')) END AS saved
      FROM p GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(k.kids, 0) AS kids FROM n LEFT JOIN k USING (p)),
a AS (SELECT f.p[1:e] AS p, sum(saved) AS saved, count(*) FILTER (WHERE kids = 0) AS leaves
      FROM f, unnest(range(0, f.d + 1)) AS u(e) GROUP BY 1)
SELECT f.c AS conv_id, CAST(f.d AS BIGINT) AS depth, q.c AS parent_conv_id, f.m AS n_convs, f.kids AS n_children,
       a.leaves AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM f JOIN a USING (p) LEFT JOIN n q ON f.d > 0 AND q.p = f.p[1:f.d - 1]
"""
