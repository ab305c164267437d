import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm import clusters
from rollcall.llm import lines as ln


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@settings(deadline=None, max_examples=200)
@given(st.text("abc", max_size=12), st.text("abc", max_size=12), st.integers(0, 12))
def test_edit_distance(a, b, most):
    real = plain_distance(a, b)
    got = ln.edit_distance(a, b, most)
    assert got == real if real <= most else got > most


words = st.lists(st.sampled_from(["ab", "abc", "b", "longer", "longest", "x", ""]), max_size=14).map(" ".join)


@settings(deadline=None, max_examples=400)
@given(words, words, st.integers(50, 95))
def test_quick_answers_are_right(a, b, percent):
    """Edits by words are never less than the distance, letters that lack never more."""
    real = plain_distance(a, b)
    assert ln.word_edits(a, b, 10**6) >= real >= ln._lacking(a, b)
    longer = max(len(a), len(b))
    assert ln.alike(a, b, percent) == (real <= longer * (100 - percent) // 100)


edited = st.lists(st.tuples(st.text("ab😀", max_size=24), st.text("ab😀", max_size=24), st.integers(0, 9)), max_size=9)


@settings(deadline=None, max_examples=200)
@given(edited, st.sampled_from([1, 40, 8192]), st.sampled_from([1, 300, 2_000_000]))
def test_bands_of_many_pairs(pairs, bits, cells):
    """Pairs compared together get the answers of each alone, whatever is worked on at once."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ln, "BAND_BITS", bits)
        patch.setattr(ln, "BAND_CELLS", cells)
        # Near ones, too: a letter put in, one taken out.
        pairs = pairs + [(a, a[:3] + "b" + a[3:-1], most) for a, _, most in pairs]
        assert ln.within(pairs).tolist() == [plain_distance(a, b) <= most for a, b, most in pairs]


def test_lines_that_are_not_alike_are_compared_together(monkeypatch):
    """No line of some length is gone through letter by letter, and links are those of all pairs."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    base = [rng.choice(vocabulary) for _ in range(50)]
    lines = []
    for _ in range(40):
        own = list(base)
        for i in rng.sample(range(50), rng.choice([2, 5, 9])):
            own[i] = rng.choice(vocabulary)
        lines.append(" ".join(own))
    pairs = [(i, j) for i in range(40) for j in range(i + 1, 40)]
    alike = [(i, j) for i, j in pairs if ln.alike(lines[i], lines[j])]
    real, sizes = ln.edit_distance, []
    monkeypatch.setattr(ln, "edit_distance", lambda a, b, most: (sizes.append(min(len(a), len(b))), real(a, b, most))[1])
    held = [(list(range(40)), *ln._quick_links(lines, pairs))]
    links = [x for b in ln._spanning(held) for x in zip(*(c.to_pylist() for c in b.columns))]
    assert held[0][2] and max(sizes) <= 2 * ln.GRAIN + 50 < min(map(len, lines))
    want, got = (clusters.spanning_links(range(40), x) for x in (alike, links))
    assert len(want) == len(got) == len(links) and set(links) <= set(alike)


def test_waiting_pairs_are_bounded(monkeypatch):
    """Pairs that would wait in too great a number are answered at once, with the same links."""
    rng = random.Random(9)
    words_ = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    base = [rng.choice(words_) for _ in range(30)]
    lines = [" ".join(w if rng.random() < 0.9 else rng.choice(words_) for w in base) for _ in range(25)]
    pairs = [(i, j) for i in range(25) for j in range(i + 1, 25)]

    def groups():
        links = [(i, j) for b in ln._spanning([(list(range(25)), *ln._quick_links(lines, pairs))]) for i, j in zip(*(c.to_pylist() for c in b.columns))]
        root = list(range(25))
        for _ in range(25):
            for i, j in links:
                root[i] = root[j] = min(root[i], root[j])
        return root

    whole = groups()
    monkeypatch.setattr(ln, "ASKED_CHARS", 0)
    assert groups() == whole and len(set(whole)) > 1


def normal(line):
    lower = "".join("0" if c in "0123456789" else c if ord(c) > 127 or c.isalnum() else " " for c in line.lower())
    return " ".join(lower.split(" ")).strip() and " ".join(x for x in lower.split(" ") if x)


def spread(h):
    h %= 2**64
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    h = (h ^ h >> 27) * 0x94D049BB133111EB % 2**64
    return h ^ h >> 31


def half_hash(data, later):
    h = int(ln.span_hashes(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))[0])
    return (spread(h + 1) if later else h) >> 20


def simhash(line):
    """192 bits over the set of the halves of all words, by plain counting."""
    halves = set()
    for w in line.encode().split():
        k = (len(w) + 1) // 2
        halves.add(half_hash(w[:k], False))
        if w[k:]:
            halves.add(half_hash(w[k:], True))
    out = 0
    for part, seed in enumerate(map(int, ln._SEEDS)):
        rows = [spread(h * seed + seed) for h in halves]
        for b in range(64):
            out |= (2 * sum(r >> b & 1 for r in rows) > len(rows)) << (64 * part + b)
    return out


def keys_of(line):
    n = len(line.split())
    return next(blocks for most, blocks in ln.BLOCKS if most is None or n <= most)


def meet(a, b, keys=12):
    """Whether two fingerprints meet: within both radii, and with one of so many blocks in common."""
    x = a ^ b
    carried = (x & 2 ** (64 * len(ln.CARRIED)) - 1).bit_count() <= ln.CARRIED_RADIUS
    return carried and x.bit_count() <= ln.RADIUS and any(not x >> 16 * i & 0xFFFF for i in range(keys))


def brute(rows, by_print):
    """Groups of equal and near lines by all pairs: by edit similarity, with or without fingerprints."""
    places = {}
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")):
            x = normal(line)
            if x and len(x) >= ln.MIN_CHARS and len(x.split()) >= ln.MIN_WORDS:
                places.setdefault(x, []).append((i is None, i, t, n))
    names = list(places)
    prints = [simhash(x) for x in names] if by_print else []
    root = list(range(len(names)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(names)):
        for j in range(i):
            if not by_print or meet(prints[i], prints[j], min(keys_of(names[i]), keys_of(names[j]))):
                longer = max(len(names[i]), len(names[j]))
                if 100 * ln.edit_distance(names[i], names[j], longer) <= longer * (100 - ln.PERCENT):
                    root[find(i)] = find(j)
    groups = {}
    for i, x in enumerate(names):
        groups.setdefault(find(i), []).extend(places[x])
    return groups


def dropped(rows, by_print):
    drop = {}
    for places in brute(rows, by_print).values():
        # of one id with several texts the first by text hash; that order is not rebuilt here
        first = min(p[:2] + (p[3],) if p[1] is not None else (True, 0, p[3]) for p in places)
        for p in places:
            if (p[0], p[1] if p[1] is not None else 0, p[3]) != first:
                drop.setdefault((p[1], p[2]), set()).add(p[3])
    return drop


def check(spark, rows, exact=True):
    """What must meet is dropped, and nothing that is not alike by its letters; ``exact``: these are one."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(ln.drop_repeated(df).collect(), key=lambda r: (str(r.doc_id), str(r.text)))
    must, may = dropped(rows, True), dropped(rows, False)
    assert not exact or must == may
    bounds = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        low, high = (len(d.get((i, t), set())) for d in (must, may))
        left = None if t is None else "\n".join(x for n, x in enumerate(lines) if n not in must.get((i, t), set()))
        bounds.setdefault(i, []).append((low, high, left, 0 if t is None else len(lines)))
    for i, own in bounds.items():
        rows_of = [r for r in got if r.doc_id == i]
        assert sorted(r.n_lines for r in rows_of) == sorted(x[3] for x in own)
        if exact:
            assert sorted((str(r.text), r.n_dropped) for r in rows_of) == sorted((str(x[2]), x[0]) for x in own)
        else:
            assert sum(x[0] for x in own) <= sum(r.n_dropped for r in rows_of) <= sum(x[1] for x in own)


def test_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 60))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            w = rng.choice(base).split()
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            line = " ".join(w)
            lines.append(rng.choice([line, line.upper() + "!", f"{line} 12", "short", ""]))
        rows.append((i, "\n".join(lines)))
    check(spark, rows, exact=False)


def test_odd_rows(spark, odd_docs):
    line = "this very line is found all over the corpus, 3 times"
    rows = [(1, f"{line}\nx\n{line}"), (1, f"{line}\nx\n{line}"), (2, None), (3, ""), (4, "\n\n"), (9, line.replace("3", "7"))]
    check(spark, rows)
    wide = ln.drop_repeated(odd_docs)
    assert wide.columns == [*odd_docs.columns, "n_lines", "n_dropped"] and wide.count() == odd_docs.count()


def test_empty_table(no_docs):
    assert ln.drop_repeated(no_docs).count() == 0


def test_large_groups(spark, monkeypatch):
    """Many variants of one line: a cluster larger than a block, met again bucket by bucket."""
    monkeypatch.setattr(clusters, "BLOCK", 8)
    monkeypatch.setattr(ln, "BLOCK", 8)
    rng = random.Random(6)
    base = [f"word{rng.randint(0, 10**6)}" for _ in range(80)]
    rows = []
    for i in range(60):
        w = list(base)
        w[rng.randrange(80)] = f"other{i}"
        rows.append((i, " ".join(w)))
    check(spark, rows, exact=False)


def near_rows(seed, n=12):
    """(key, node, fingerprint) of every block of some fingerprints and near ones of them, sorted."""
    rng = random.Random(seed)
    prints = [rng.getrandbits(192) for _ in range(n)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(192), rng.randint(0, 60))) for p in prints for _ in range(4)]
    rows = [(i << 22 | p >> 16 * i & 0xFFFF, node, p) for node, p in enumerate(prints) for i in range(12)]
    return prints, sorted(rows)


def as_arrays(rows):
    split = [[p >> 64 * i & 2**64 - 1 for i in range(3)] for _, _, p in rows]
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array(split, np.uint64)


@pytest.mark.parametrize("large", [3, 1024])
@pytest.mark.parametrize("cut", [1, 2, 7, 100, 10_000])
def test_buckets_over_batches(monkeypatch, large, cut):
    """The sorted stream connects what meets in a bucket, wherever batches are cut."""
    monkeypatch.setattr(ln, "LARGE_BUCKET", large)
    monkeypatch.setattr(ln, "ROWS_AT_ONCE", 1)
    caught = {}

    class Frame:
        def __getattr__(self, name):
            return lambda *a, **k: (caught.update(run=a[0]), self)[1] if name == "mapInArrow" else self

    prints, rows = near_rows(cut)
    key, node, own = as_arrays(rows)
    monkeypatch.setattr(ln, "_keys", lambda: ln.F.lit(1))
    ln.near_by_print(type("D", (), {"select": lambda s, *a: Frame()})())
    signed = own.view(np.int64)
    columns = {"key": key, "node": node, **{p: np.ascontiguousarray(signed[:, i]) for i, p in enumerate(ln.PRINT)}}
    batches = [
        pa.RecordBatch.from_pydict({k: v[i : i + cut] for k, v in columns.items()}) for i in range(0, len(key), cut)
    ]
    links = [(u, v) for b in caught["run"](iter(batches)) for u, v in zip(*(c.to_pylist() for c in b.columns))]
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in links:
        root[find(u)] = find(v)
    met = [(i, j) for i in range(len(prints)) for j in range(i) if meet(prints[i], prints[j])]
    assert met and all(find(i) == find(j) for i, j in met)
    if large > 1000:
        assert links
        assert all((prints[u] ^ prints[v]).bit_count() <= 4 * ln.RADIUS for u, v in links)


def test_partners_meet_once():
    """Of two near fingerprints each is held in the first bucket that they share, and there only."""
    prints, rows = near_rows(3)
    key, node, own = as_arrays(rows)
    kept = ln._has_partner(key, own)
    want = set()
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= ln.RADIUS and any(
                not (prints[i] ^ prints[j]) >> 16 * b & 0xFFFF for b in range(12)
            ):
                first = next(b for b in range(12) if not (prints[i] ^ prints[j]) >> 16 * b & 0xFFFF)
                want |= {(first, i), (first, j)}
    assert {(int(key[x]) >> 22, int(node[x])) for x in np.flatnonzero(kept)} == want


def prints_of(lines):
    own = ln.Lines(pa.array(["\n".join(lines)]))
    assert len(own.name) == len(lines)
    return [int.from_bytes(p.tobytes(), "little") for p in own.prints(np.arange(len(lines)))]


def test_fingerprints_are_those_of_the_definition():
    many = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(600))
    lines = ["the quick brown fox jumps a over the lazy dog", "这是一个非常长的句子它没有任何空格但是在许多文件中反复出现", "ab " * 500, many]
    assert prints_of(lines) == [simhash(normal(x)) for x in lines]


@pytest.mark.parametrize("words", [10, 20, 40, 80])
@pytest.mark.parametrize("change", ["letter", "word"])
def test_recall_of_near_lines(words, change):
    """Of the lines that are alike by their letters alone at least nine in ten meet by fingerprint."""
    rng = random.Random(words)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvw") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    pairs = []
    while len(pairs) < 300:
        line = " ".join(rng.choice(vocabulary) for _ in range(words))
        if change == "letter":
            i = rng.choice([i for i, c in enumerate(line) if c != " "])
            other = line[:i] + "z" + line[i + 1 :]
        else:
            own = line.split()
            own.insert(rng.randint(0, words), rng.choice(vocabulary))
            other = " ".join(own)
        if ln.alike(line, other):
            pairs += [(line, other)]
    a, b = (prints_of(list(x)) for x in zip(*pairs))
    found = sum(meet(x, y, min(keys_of(p), keys_of(q))) for x, y, (p, q) in zip(a, b, pairs))
    print(f"{words} words, {change}: {found} of {len(pairs)}")
    assert found >= 0.9 * len(pairs)


def test_recall_over_a_corpus(corpus):
    """All pairs of different lines of a corpus that are alike by their letters: nine in ten meet."""
    texts = [r.text or "" for r in corpus("0.01")[0].select("text").collect()]
    names = sorted({x for x in ln.plain(sorted({x for t in texts for x in t.split("\n")})) if len(x) >= ln.MIN_CHARS}, key=len)
    sizes = np.array([len(x) for x in names])
    counts = np.array([np.bincount(np.frombuffer(x.encode("latin-1", "replace"), np.uint8), minlength=256) for x in names], np.int16)
    counts = counts[:, counts.any(0)]
    alike = []
    for i in range(len(names)):
        first = int(np.searchsorted(sizes, 0.9 * sizes[i] - 1))
        # As many edits at least as one has letters that the other lacks.
        lacking = np.abs(counts[first:i] - counts[i]).sum(1) + sizes[i] - sizes[first:i]
        for j in (np.flatnonzero(lacking <= 0.2 * sizes[i]) + first).tolist():
            if ln.alike(names[i], names[j]):
                alike.append((i, j))
    own = ln.Lines(pa.array(["\n".join(names)]))
    every = np.arange(len(names))
    prints, blocks, (low, high) = own.prints(every), own.blocks(every), own.classes(every)
    found = 0
    for i, j in alike:
        apart = prints[i] ^ prints[j]
        met = ln._first_key(apart[None])[0] < min(blocks[i], blocks[j]) and low[i] <= high[j] and low[j] <= high[i]
        carried = np.bitwise_count(apart[: len(ln.CARRIED)]).sum() <= ln.CARRIED_RADIUS
        found += met and carried and np.bitwise_count(apart).sum() <= ln.RADIUS
    print(f"{len(names)} lines, {len(alike)} alike, {found} found")
    assert len(alike) > 100 and found >= 0.9 * len(alike)


def test_alike_lines_share_a_class():
    """Whatever their lengths, two lines that may be alike have a class in common."""
    for n in range(23, 3000, 7):
        m = -(-9 * n // 10)
        own = ln.Lines(pa.array(["a" * n + "\n" + "b" * m]))
        (low, low2), (high, high2) = own.classes(np.arange(2))
        assert low <= high2 and low2 <= high


def test_keys_are_blocks_with_classes(spark):
    """Every keyed block of a fingerprint once for each class; made by code short enough to be compiled."""
    rng = random.Random(2)
    signed = [rng.getrandbits(64) - 2**63 for _ in range(12)]
    rows = [(i, *signed[3 * i : 3 * i + 3], b, low, high) for i, (b, low, high) in enumerate([(8, 5, 5), (12, 6, 7), (8, 62, 63), (12, 0, 0)])]
    names = "node long, p0 long, p1 long, p2 long, blocks int, low int, high int"
    lines = spark.createDataFrame(rows, names)
    caught = {}

    class Frame:
        """What is dealt out by key, caught before."""

        def __init__(self, df):
            self.df = df

        def select(self, *a):
            return Frame(self.df.select(*a))

        def repartition(self, *a):
            caught["df"] = self.df
            return self

        def sortWithinPartitions(self, *a):
            return self

        def mapInArrow(self, *a):
            return self

    ln.near_by_print(Frame(lines))
    got = sorted((r.node, r.key) for r in caught["df"].collect())
    want = []
    for node, p0, p1, p2, blocks, low, high in rows:
        whole = sum((p % 2**64) << 64 * i for i, p in enumerate((p0, p1, p2)))
        for size in {low, high}:
            want += [(node, i << 22 | size << 16 | whole >> 16 * i & 0xFFFF) for i in range(blocks)]
    assert got == sorted(want)
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    plan = caught["df"]._jdf.queryExecution().executedPlan()
    codes = getattr(debug, "package$").__getattr__("MODULE$").codegenStringSeq(plan)
    sizes = [codes.apply(i)._3().maxMethodCodeSize() for i in range(codes.size())]
    print(f"bytes of the longest method: {sizes}")
    assert sizes and max(sizes) < 8000


def test_one_fingerprint_per_name():
    """Blanks and marks do not change a fingerprint, and lines that differ much are far apart."""
    one, two, other = prints_of([
        "  averyveryverylongtoken,   another", "(averyveryverylongtoken another)",
        "这是一个非常长的句子它没有任何空格但是在许多文件中反复出现",
    ])
    assert one == two and (one ^ other).bit_count() > ln.RADIUS
