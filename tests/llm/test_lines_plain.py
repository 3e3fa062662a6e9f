"""Line dedup against a plain version of its rules, line by line (hashes only break ties)."""

import random
from collections import defaultdict

import pytest
import regex
import xxhash

from tallybayes.llm import linededup, queries
from tallybayes.llm.storage import documents

SF = "/root/testdata/sf0.001"
UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}"
                         r"、-〿！-･]")
BLANK = " \t\x0b\f\r"


def canonical(line):
    tokens = [t for t in regex.split(f"[{BLANK}]+", line) if t]
    if " ".join(tokens) == line and not regex.search("[0-9]", line):
        return line
    digits = [bool(regex.search("[0-9]", t)) for t in tokens]
    if all(digits) and len(tokens) < 4 and not UNSPACED.search(line):
        return " ".join(tokens)
    return " ".join(t if not d else regex.sub("[0-9]+", "<*>", t) if not t.isascii() and UNSPACED.search(t) else "<*>"
                    for t, d in zip(tokens, digits))


def size_of(line):
    n = line.count(" ") + 1
    return max(n, len(UNSPACED.findall(line))) if len(line.encode()) - len(line) > 2 * n else n


def spot(at, token):
    h = xxhash.xxh64_intdigest(token.encode(), xxhash.xxh64_intdigest(at.to_bytes(4, "little"), 42))
    return h - 2**64 if h >= 2**63 else h


class Kind:
    """A different line: the documents that have it."""

    def __init__(self, line):
        self.line, self.tokens, self.ids, self.size = line, line.split(" "), set(), size_of(line)

    evidence = property(lambda self: len(self.ids) * self.size)
    first = property(lambda self: min(self.ids, default=None))
    last = property(lambda self: max(self.ids, default=None))


def recurs(kinds):
    first, last = min(k.first for k in kinds), max(k.last for k in kinds)
    return first != last and sum(k.evidence for k in kinds) >= 40


def templates(kinds):
    """Line -> first document, of the lines of recurring templates."""
    leaves = defaultdict(list)
    for k in kinds.values():
        if len(k.tokens) >= 6:
            leaves[len(k.tokens), tuple(k.tokens[:4])].append(k)
    found = {}
    for (n, _), all_kinds in leaves.items():
        held = [k for k in all_kinds if k.ids]
        if len(all_kinds) < 2 or not held or not recurs(held):
            continue
        majority = {}
        for at in range(n):
            counts = defaultdict(int)
            for k in held:
                counts[k.tokens[at]] += 1
            majority |= {at: t for t, c in counts.items() if 2 * c > len(all_kinds)}
        members = [k for k in held if 4 * sum(majority.get(i) == t for i, t in enumerate(k.tokens)) >= 3 * n]
        if members and recurs(members):
            found |= {k.line: min(m.first for m in members) for k in members}
        rest = [k for k in held if k.line not in found]
        while rest:
            counts = defaultdict(int)
            for k in rest:
                for at in range(4, n):
                    counts[at, k.tokens[at]] += 1
            need = -(-3 * n // 4) - 4
            groups, options = defaultdict(list), {}
            for k in rest:
                top = sorted(((counts[at, t], spot(at, t)) for at, t in enumerate(k.tokens) if at >= 4 and counts[at, t] > 1),
                             reverse=True)[:need + 1]
                if len(top) >= need:
                    whole = frozenset(s for _, s in top)
                    options[k.line] = [whole - {s} for s in whole] if len(top) > need else [whole]
                    for v in options[k.line]:
                        groups[v].append(k)

            def xor(v):
                out = 0
                for s in v:
                    out ^= s
                return out

            weight = {v: sum(k.evidence for k in g) for v, g in groups.items() if recurs(g)}
            taken = defaultdict(list)
            for k in rest:
                mine = [v for v in options.get(k.line, []) if v in weight]
                if mine:
                    taken[max(mine, key=lambda v: (weight[v], xor(v)))].append(k)
            new = {k.line: min(m.first for m in g) for g in taken.values() if len(g) > 1 and recurs(g) for k in g}
            found |= new
            rest = [k for k in rest if k.line not in new] if new else []
    return found


def plain(rows):
    rows = list(rows)
    lines = {row: [canonical(x) for x in (row[1] or "").split("\n")] for row in rows}
    lines = {row: [x for x in xs if x] for row, xs in lines.items()}
    kinds = {}
    for (doc, _), xs in lines.items():
        for x in xs:
            k = kinds.setdefault(x, Kind(x))
            if doc is not None:
                k.ids.add(doc)
    first = templates(kinds)
    shared = dict(first)
    for k in kinds.values():
        if k.ids and k.first != k.last:
            own = k.first if k.evidence >= 40 else None
            known = [f for f in (shared.get(k.line), own) if f is not None]
            shared[k.line] = min(known, default=None)
    gone = {row: {i for i, x in enumerate(xs) if shared.get(x) is not None and shared[x] != row[0]} for row, xs in lines.items()}
    passages = defaultdict(list)
    for row, xs in lines.items():
        at = 0
        while at < len(xs):
            end = at
            while end < len(xs) and xs[end] in shared:
                end += 1
            for i in range(at, end):
                for j in range(i + 2, min(end, i + 21) + 1):
                    part = xs[i:j]
                    sizes = [size_of(x) for x in part]
                    if any(shared[x] is None for x in part) and sum(sizes) - max(sizes[0], sizes[-1]) < 20:
                        passages[tuple(part)].append((row, i))
            at = max(end, at + 1)
    for part, places in passages.items():
        ids = {row[0] for row, _ in places if row[0] is not None}
        if len(ids) > 1 and len(ids) * sum(map(size_of, part)) >= 40:
            for row, i in places:
                if row[0] != min(ids):
                    gone[row] |= set(range(i, i + len(part)))
    out = []
    for doc, text in rows:
        if text is None:
            out.append((doc, None, 0, 0))
            continue
        drop, at, kept = gone[doc, text], -1, []
        for x in text.split("\n"):
            blank = not canonical(x)
            at += not blank
            if blank or at not in drop:
                kept.append(x)
        out.append((doc, "\n".join(kept), text.count("\n") + 1, len(drop)))
    return sorted(out, key=repr)


def collected(df):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect()), key=repr)


def test_query_matches_plain_version(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    assert collected(queries.op5_linededup(spark, SF)) == plain(rows)


@pytest.mark.parametrize("seed", range(2))
def test_random_leaves_and_passages(spark, seed):
    rng = random.Random(seed)
    heads = ["the log of the", "we saw that the", "日本 語 の 文"]
    fields = [["job", "task", "unit"], ["ran", "failed", "slept"], ["on", "at"], ["node", "disk"], ["well", "late", "never"], ["a1", "b22", "c"]]
    passage = ["one small", "step for a", "man and then", "the 3 others", "came along here", "to see it all now", "by day and night", "end"]

    def line():
        kind = rng.random()
        if kind < 0.5:
            return rng.choice(heads) + " " + " ".join(rng.choice(f) for f in fields[:rng.choice([2, 4, 6])])
        if kind < 0.7:
            return rng.choice(["", "short", "12 7", "12 8", " padded  out ", "東京都の長い文は空白がない", "x\ty", "Fig. 3", "ok\r"])
        return " ".join(rng.choices(["sun", "sea", "sky", "42", "rock"], k=rng.choice([1, 3, 7, 12])))

    rows = []
    for i in range(60):
        xs = [line() for _ in range(rng.choice([0, 1, 4, 12]))]
        if i % 9 == 0:
            a = rng.randrange(0, 3)
            at = rng.randrange(len(xs) + 1)
            xs[at:at] = passage[a:a + rng.choice([5, 8])]
        rows.append((i, "\n".join(xs)))
    rows += [rows[5], (5, "other\n" + rows[6][1]), (None, rows[9][1]), (100, None), (101, "")]
    got = collected(linededup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    want = plain(rows)
    assert got == want and sum(r[3] for r in want) > 50


def test_clean_lines_drops_emptied_documents_only(spark):
    line = "the same fourteen words stand here in every one of the three documents above"
    rows = [(1, f"{line}\nits own"), (2, line), (3, f" \t\n{line}\n\n"), (4, f"\t{line}\nkept 7"), (5, None), (6, ""), (7, " \n\t"), (None, line)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    every = linededup.drop_recurring_lines(df).collect()
    want = [(r["doc_id"], r["text"]) for r in every if not r["n_dropped"] or regex.search(r"[^ \t\n\x0b\f\r]", r["text"])]
    got = [tuple(r) for r in linededup.clean_lines(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[0] for r in got} == {1, 4, 5, 6, 7} and (4, "kept 7") in got
