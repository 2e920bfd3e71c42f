from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from prepkit.llm import merkle


def h(s):
    return sha256(s.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def raised(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), with plain lists."""
    groups = {}
    for i, text, lang, source in rows:
        bent = text.replace("\n", "") if text is not None and i is not None and crc32(str(i).encode()) % 2 == 0 else text
        n = None if text is None else len(text)
        groups.setdefault(source, []).append((i is not None, i, leaf((i, source, lang, n, text)), leaf((i, source, lang, n, bent))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: raised([x[2] for x in sorted(groups[s], key=lambda x: (x[0], x[1] or 0, x[2]))]) for s in order}
    top = raised([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for place, (_, i, own, node) in enumerate(sorted(groups[s], key=lambda x: (x[0], x[1] or 0, x[2]))):
            proof = ""
            for tree, at in ((trees[s], place), (top, k)):
                for nodes in tree[:-1]:
                    first = at - at % 3
                    left, right = "".join(nodes[first:at]), "".join(nodes[at + 1:first + 3])
                    proof, node, at = proof + left + right, h(left + node + right), at // 3
            out.append((i, own, trees[s][-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r))


def test_odd_rows_equal_plain_lists(odd, odd_rows, empty):
    assert got(merkle.tampered_digests(odd)) == brute(odd_rows)
    assert merkle.tampered_digests(empty).collect() == []


def test_one_row_is_the_root(docs):
    (r,) = merkle.tampered_digests(docs([(1, "a", "en", "s")])).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == h("") and r.verified


@pytest.mark.parametrize("height", [2, 3])
def test_blocks_of_any_height_make_the_same_tree(docs, height):
    rows = [(i, f"line {i}\nmore" if i % 3 else None, "en", ("hot", None, f"s{i % 11}")[min(i % 4, 2)]) for i in range(230)]
    frame = docs(rows)
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = merkle.versions(frame, {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}, even, height=height)
    text = [(r.id, bytes(r.leaf).hex(), bytes(r.subroot).hex(), bytes(r.root).hex(), h("".join(bytes(x).hex() for x in r.proof)),
             bytes(r.version[-1]).hex(), r.version[-1] == r.root) for r in found.collect()]
    assert sorted(text) == brute(rows)


def test_a_version_copies_ancestors_only(docs):
    rows = [(i, f"text {i}\n", "en", f"s{i % 2}") for i in range(60)]
    changed = merkle.versions(docs(rows), {"text": F.lit("other")}, F.col("doc_id") == 17).collect()
    plain = {r.id: r for r in merkle.versions(docs(rows)).collect()}
    for r in changed:
        assert r.proof == plain[r.id].proof  # siblings are shared
        same = [a == b for a, b in zip(r.version, plain[r.id].version)]
        assert all(same) if r.id != 17 else not any(same)


def test_many_equal_rows_and_missing_ids(docs):
    rows = [(None, "same\ntext", "en", "a")] * 40 + [(5, "x\n", None, None)] * 7
    assert got(merkle.tampered_digests(docs(rows))) == brute(rows)
