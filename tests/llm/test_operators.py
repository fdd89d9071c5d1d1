"""Each operator against brute force on small tables, and its edge cases."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfmark.llm import chat, decontaminate, html_text, mixing, neardup, outliers, repeats, sharding, templates, tokens
from shelfmark.llm.components import components
from shelfmark.llm.queries import TOKENIZERS

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PLAIN, LETTERS = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, c0 int, size int, mix int, text_a string"


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, nulls, ties, odd characters, a long text."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdeéüß日", k=draw.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(draw.choices(vocabulary, k=n))
    passage, texts = prose(90), [None, "", "  \n\t ", "one", "two words", "x" * 900, "a b " * 300, prose(9000)]
    for i in range(60):
        base = prose(draw.randint(30, 150))
        texts.append(f"{base}\nLog line {i} of user u{i} at host\n{passage if i % 3 == 0 else prose(20)}")
        words = base.split(" ")
        if i % 2:
            for _ in range(draw.choice([1, 2, 5, 20])):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            texts.append(" ".join(words))
    texts += texts[20:30] + [texts[9]] * 5
    return [(i, t, draw.choice(["en", None]), draw.choice(["s0", "s0", "s1", None]), 1, 2, 3, "x") for i, t in enumerate(texts)] + [
        (None, "lone text of no id", "en", "s1", 1, 2, 3, "x"), (7, "another text under an id", "en", "s1", 1, 2, 3, "x"),
        (3, "one", "en", "s1", 1, 2, 3, "x"),
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def words(text, pattern=PLAIN):
    return pattern.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("width, percent", [(4, 80), (2, 60)])
def test_near_duplicates(docs, rows, width, percent):
    sets = []
    for row in rows:
        w = words(row[1])
        sets.append({tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1 if w else 0))})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, row in enumerate(rows):
        least[find(i)].append(row[0])
    want = Counter()
    for i, row in enumerate(rows):
        ids = [x for x in least[find(i)] if x is not None]
        low = (min(ids) if ids else None) if sets[i] else row[0]
        want[row[0], len(sets[i]), low, low == row[0]] += 1
    if percent == 80:
        assert Counter(map(tuple, neardup.near_duplicates(docs, width=width, percent=percent).collect())) == want
        kept = neardup.without_near_duplicates(docs, width=width).select("doc_id", "text")
        assert Counter(map(tuple, kept.collect())) == Counter({(r[0], r[1]) for r, (k, n) in zip(rows, _kept(rows, sets, least, find)) if k})
    else:  # bands are made for 0.8: nothing false is linked
        got = neardup.near_duplicates(docs, width=width, percent=percent).collect()
        assert sum(r.kept for r in got) >= sum(n for (_, _, _, k), n in want.items() if k)


def _kept(rows, sets, least, find):
    for i, row in enumerate(rows):
        ids = [x for x in least[find(i)] if x is not None]
        low = (min(ids) if ids else None) if sets[i] else row[0]
        yield low == row[0], i


def test_one_near_duplicate_stays_without_ids_or_under_one(spark):
    base = [f"w{i}" for i in range(200)]
    near = lambda at, c: " ".join([*base[:at], c, *base[at + 1 :]])
    other = " ".join(f"v{i}" for i in range(50))
    rows = [(None, near(9, "x")), (None, near(9, "y")), (None, other), (5, other.upper() + " z"), (5, other)]
    kept = neardup.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 5] and {r.text for r in kept if r.doc_id is None} < {rows[0][1], rows[1][1]}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(50, 50), (60, 61), (61, 60), (70, None)]
    got = {tuple(r) for r in components(spark.createDataFrame(chain, "a int, b int"), "a", "b").collect()}
    assert got == {(i, 0) for i in range(41)} | {(60, 60), (61, 60)}


@pytest.mark.parametrize("together", [4096, 2])
def test_repeats(docs, rows, together, monkeypatch):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    count = Counter()
    for row in rows:
        b = (row[1] or "").encode()
        count.update(b[i : i + 400] for i in range(len(b) - 399))
    want = Counter()
    for row in rows:
        b = (row[1] or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - 399):
            if count[b[i : i + 400]] > 1:
                gone[i : i + 400] = [True] * 400
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want[row[0], len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    got = repeats.repeats(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got) == want
    with pytest.raises(ValueError):
        repeats.repeats(docs, length=100)


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_contamination(spark, docs, rows, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = [(1, rows[10][1]), (2, "two words"), (3, None), (4, "."), (5, rows[10][1]), (None, rows[7][1][:200])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for name, text in items:
        w = words(text, LETTERS)
        for i in range(max(len(w) - 9, 1 if w else 0)):
            windows[tuple(w[i : i + 10])].add(name)
    for row in decontaminate.contamination(docs, benchmark).collect():
        w, hit, names = words(row.text, LETTERS), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if (found := windows.get(tuple(w[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    names |= found
        spans = {i for s in row.contamination.spans for i in range(s.start, s.end)}
        want = (len(w), len(hit), sorted(str(n) for n in names if n is not None))
        assert (row.contamination.n_words, row.contamination.n_hit, row.contamination["items"]) == want and spans == hit
    assert decontaminate.contamination(docs, benchmark).columns == [*docs.columns, "contamination"]
    assert decontaminate.contamination(docs, benchmark.limit(0)).where("contamination.n_hit > 0").count() == 0


def test_mixing(docs, rows):
    got = mixing.mix(docs, name="mix_").collect()
    assert sorted(map(str, (r[:8] for r in got))) == sorted(map(str, rows))
    held, taken, target = Counter(), Counter(), {}
    for r in got:
        m = r["mix_"]
        assert m["size"] == len(words(r.text)) and len(m.moments) <= 3 and all(0 <= x <= 1 for x in m.moments)
        held[r.source] += m["size"]
        taken[r.source] += m["size"] * len(m.moments)
        target[r.source] = m.target
    assert sum(target.values()) == pytest.approx(sum(held.values()))
    level = max(t / w for t, w in zip((target["s0"], target["s1"], target[None]), (5, 2, 1)) )
    for source, weight in (("s0", 5), ("s1", 2), (None, 1)):
        assert target[source] == pytest.approx(min(3 * held[source], weight * level), abs=1e-3)
        largest = max(len(words(r.text)) for r in got if r.source == source)
        assert abs(taken[source] - target[source]) <= largest / 2 + 1
    again = mixing.mix(docs.repartition(2), name="mix_").collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    ordered = mixing.curriculum(docs.select("doc_id", "text", "source"))
    assert sum(len(words(r.text)) for r in ordered.collect()) == sum(taken.values())


def test_shards(docs, rows):
    got = sharding.shards(docs, count=4, name="place").collect()
    assert sorted(map(str, (r[:8] for r in got))) == sorted(map(str, rows))
    slots, shard_of = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.place.shard].append(r.place.slot)
        shard_of[r.text].add(r.place.shard)
        assert r.place["size"] == len((r.text or "").encode()) + 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))
    assert all(len(s) == 1 for s in shard_of.values())
    held = Counter()
    for r in sharding.shards(docs, count=None, capacity=60_000).collect():
        held[r.sharding.shard] += r.sharding["size"]
    assert max(held.values()) <= max(60_000, max(len((r[1] or "").encode()) for r in rows) + 1)


def test_balanced_tree_is_a_best_fit():
    draw = random.Random(3)
    sizes = sorted((draw.randint(1, 60) for _ in range(400)), reverse=True)
    rooms, want = [], []
    for size in sizes:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        at = min(fits)[1] if fits else len(rooms)
        if not fits:
            rooms.append(100)
        rooms[at] -= size
        want.append(at)
    assert sharding.best_fit(sizes, 100) == (want, len(rooms))
    assert sharding.best_fit(sizes, sharding.least_capacity(sizes, 7))[1] <= 7


def test_quality_counts_and_verdicts(spark, docs, rows):
    got = outliers.quality(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text, w = r.text or "", PLAIN.findall(r.text or "")
        seen, dup = set(), 0
        for line in text.split("\n"):
            if line.split():
                dup += line in seen
                seen.add(line)
        grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        often = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        q = r.quality
        want = (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(often))
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == want
        assert q.base_failed == (len(w) < 20 or 100 * len(often) > 30 * len(w))
        assert not (q.kept and q.base_failed)
    draw = random.Random(1)
    prose = [(i, " ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(120)) + ".", "en", "s") for i in range(120)]
    noise = [(i, " ".join(f"{w}###" for w in prose[i % 100][1].split()), "en", "s") for i in range(1000, 1020)]
    kept = outliers.quality(spark.createDataFrame(prose + noise, "doc_id long, text string, lang string, source string"))
    assert {r.doc_id for r in kept.where("quality.kept").collect()} == set(range(120))


def _least_determinant(x, dice, starts=60):
    """Minimum covariance determinant over all rows: exact steps from many small random subsets."""
    wanted = -(-3 * len(x) // 4)
    floor = np.diag(np.array(list(outliers.COORDINATES.values())) ** 2)
    best = None
    for _ in range(starts):
        chosen, last = dice.choice(len(x), 8, replace=False), np.inf
        while True:
            centre = x[chosen].mean(0)
            cov = np.cov(x[chosen].T, bias=True) * (outliers.NARROW if len(chosen) == wanted else 1.0) + floor
            logdet = np.linalg.slogdet(cov)[1] if len(chosen) == wanted else np.inf
            if len(chosen) == wanted and logdet > last - 1e-9:
                break
            last = logdet
            far = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
            chosen = np.argsort(far, kind="stable")[:wanted]
        if best is None or last < best[0]:
            best = last, far
    return best


def test_quality_estimate_is_the_least_determinant(spark):
    """Against numpy over all rows: pools of one cloud, of a cloud with a far cluster, and of equal rows with some others."""
    dice = np.random.default_rng(3)
    spread = np.array(list(outliers.COORDINATES.values())) * 3
    turn = np.linalg.qr(dice.normal(size=(6, 6)))[0]
    clouds = {
        "one": dice.normal(size=(400, 6)) * spread @ turn + 2,
        "two": np.vstack([dice.normal(size=(330, 6)) * spread @ turn, dice.normal(size=(80, 6)) * 0.02 + spread * 8]),
        "equal": np.vstack([np.ones((200, 6)), 1 + dice.normal(size=(40, 6)) * spread]),
    }
    whole = {pool: np.rint(x * outliers.UNIT).astype(np.int64) for pool, x in clouds.items()}
    rows = [(pool, *map(int, row)) for pool, x in whole.items() for row in x]
    kind = "pool string, " + ", ".join(f"{name} long" for name in outliers.NAMES)
    got = {r.pool: r for r in outliers.estimates(spark.createDataFrame(rows, kind)).collect()}
    assert set(got) == set(clouds)
    for pool, x in whole.items():
        x, r = x / outliers.UNIT, got[pool]
        logdet, want = _least_determinant(x, dice)
        assert r.logdet <= logdet + 0.01
        shape = np.zeros((6, 6))
        for i, j in outliers._PAIRS:
            shape[i, j] = r[f"l{i}{j}"]
        off = (x - [r[f"m{i}"] for i in range(6)]) @ shape.T
        far = (off**2).sum(1)
        assert ((far > outliers.LIMIT) == (want > outliers.LIMIT)).mean() > 0.99
        if pool == "two":  # the cluster is not in the estimate
            assert far[330:].min() > outliers.LIMIT > np.quantile(far[:330], 0.95)


def test_chi_square_limits():
    assert outliers.chi_square_limit(0.75, 6) == pytest.approx(7.8408, abs=1e-3)
    assert outliers.chi_square_limit(0.999999, 6) == pytest.approx(38.258, abs=1e-2)


def test_token_counts_equal_the_tokenizer(spark, docs):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = tokens.unigram_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    low = [("<unk>", 0.0), *((f"<0x{i:02X}>", 0.0) for i in range(256))]
    exact = Tokenizer(models.Unigram([*low, *vocabulary], unk_id=0, byte_fallback=True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace()
    texts = {r.text for r in docs.select("text").collect()} | {"🎉🎉 ﬀﬀ a b", "日本語 Wörter"}
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(sorted(texts, key=str))], "doc_id long, text string")
    want = {t: len(exact.encode(" ".join(PLAIN.findall(t or "")), add_special_tokens=False).ids) if words(t) else 0 for t in texts}
    for r in tokens.token_counts(frame, vocabulary).join(frame, "doc_id").collect():
        assert (r.n_words, r.n_tokens) == (len(words(r.text)), want[r.text])


def test_token_counts_of_whole_texts_equal_the_tokenizer(spark, docs):
    from tokenizers import Tokenizer, models, normalizers

    vocabulary = tokens.unigram_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    low = [("<unk>", 0.0), *((f"<0x{i:02X}>", 0.0) for i in range(256))]
    exact = Tokenizer(models.Unigram([*low, *vocabulary], unk_id=0, byte_fallback=True))
    exact.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    texts = {r.text or "" for r in docs.select("text").collect()} | {
        "ab\ncd ef", "a\tb\n\n\n  c", " ", "\n", "    x = 1;\r\n\r\n\ty ", "a  \n b" + " " * 77 + "c", "▁ ▁a▁ b", "\v\f \u00a0 é",
    }
    frame = spark.createDataFrame(list(enumerate(sorted(texts))), "doc_id long, text string")
    for r in tokens.token_counts(frame, vocabulary, whole=True).join(frame, "doc_id").collect():
        want = len(exact.encode(r.text, add_special_tokens=False).ids)
        assert (r.n_words, r.n_tokens) == (len(words(r.text)), want), repr(r.text[:80])


@pytest.mark.parametrize("more", [[], ["a▁b", "▁▁a"], ["a\n", "\n\n", "▁\t▁"], ["b▁", "▁\n", "\n▁", "\ta"]])
def test_whole_texts_are_cut_where_no_piece_crosses(more):
    draw = random.Random(7)
    counter = tokens.Whole([(p, -1.5 * len(p) + 0.25 * i) for i, p in enumerate(["▁", "a", "▁a", "ab", "▁▁", "▁▁▁▁", *more])])
    for _ in range(400):
        text = "".join(draw.choices("ab \n\t▁é\r", k=draw.randint(1, 14)))
        assert counter.of(text.encode()) == counter.count("▁" + text.replace(" ", "▁")), repr(text)


def test_token_ties_go_to_the_piece_that_starts_first():
    counter = tokens.Counter([("▁", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁ab", -2.0)])
    assert counter[b"ab"] == 1 and counter[b"abab"] == 2 and counter[b"zz"] == 3


def test_line_templates(docs, rows):
    got = templates.template_lines(docs).collect()
    assert len(got) == len(rows)
    texts = Counter((r[0], r[1] or "") for r in rows)
    for r in got:
        assert not re.search(r"^Log line \d+ of user", r.kept, re.M)
    left = Counter((r.doc_id, r.kept) for r in got if not r.n_dropped)
    assert not left - texts and sum(r.n_dropped for r in got) >= 60


def test_short_lines_are_templates(spark):
    texts = [f"Own text number {'x' * i} of it\nMenu\nRead more\nPage {i}\n{i}\nWord {'y' * i}\n\n" for i in range(12)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in templates.template_lines(frame).collect():
        assert r.kept.split("\n")[-4:] == [str(r.doc_id), f"Word {'y' * r.doc_id}", "", ""]
        assert not {"Menu", "Read more", f"Page {r.doc_id}"} & set(r.kept.split("\n"))


def test_template_leaf_generalises():
    leaf = templates.Leaf(5)
    lines = [[1, 2, 3, 4, 5], [1, 2, 3, 9, 5], [1, 2, 3, 8, 5], [1, 2, 7, 7, 7]]
    import numpy as np

    assert [leaf.put(np.array(x, np.uint64)) for x in lines] == [0, 0, 0, 1]
    assert leaf.rows[0].tolist() == [1, 2, 3, 0, 5]


@pytest.fixture(scope="module")
def tokenizer():
    with open(f"{TOKENIZERS}/byte_bpe_50k.json") as file:
        return file.read()


@pytest.mark.parametrize("part", [1 << 20, 10])
def test_chat_round_trip(spark, tokenizer, part, monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARACTERS", part)
    odd = ["", " ", "\\", "\\\\<turn>", "</turn></turn", "<\\says>", "<|endoftext|>", "é🎉\n\n", "a" * 50, None]
    turns = [(c, t, draw, text) for c in (1, 2, None) for t, text in enumerate(odd) for draw in ("user", "assistant")]
    turns += [(5, 1, None, "x"), (5, None, "assistant", "first"), (5, 1, None, "x"), (6, 0, "a<says>b", "y")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.formatted(table, tokenizer)).collect()}
    groups = defaultdict(list)
    for c, t, role, text in turns:
        groups[c].append((-1 if t is None else t, role or "", text or ""))
    assert got.keys() == groups.keys()
    for c, group in groups.items():
        group.sort()
        learnt = "".join(x[2] for x in group if x[1] == "assistant")
        whole = "".join(f"{x[1]}\n{x[2]}\n" for x in group)
        want = (len(group), hashlib.sha256(whole.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
        assert got[c][1:5] == want
    assert chat.formatted(table.limit(0), tokenizer).count() == 0


def test_main_text(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Home</ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><article><h1>Head &amp; line</h1><p>Long enough text of the\n article "
        "with <b>bold</b> and <i>more</i> words in it<br>and on.<p>Short.<script>var x='</p>'</script>"
        "<div class=ad>Buy</div><form><p>Mail</p></form><p>End&nbsp;of it &lt;here&gt;.</p><section class='comments'>"
        "<p>First! A long comment of a reader that is no part of the text at all.</p></section></article>"
        "<aside>Side</aside><footer>&copy; x</footer></body></html>"
    )
    want = "Head & line\nLong enough text of the article with bold and more words in it and on.\nShort.\nEnd of it <here>."
    assert html_text.main_text(page) == want
    pages = [(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<nav>a</nav>", "x"), (5, "u", "plain <b>text", "x")]
    got = html_text.extracted(spark.createDataFrame(pages, "page_id long, url string, html string, text string")).collect()
    assert {r.page_id: r.text for r in got} == {1: want, 2: "", 3: "", 4: "", 5: "plain text"}
    assert html_text.main_text("<div><p>" + "<b>x</b> " * 5000) == " ".join(["x"] * 5000)


def test_main_text_without_an_article():
    text, links = "Many words of the text. " * 20, "<div><ul><li><a href=x>Other page</a><li><a href=y>More</a></ul></div>"
    one, many = f"<div>{text}</div>", "<div>" + f"<p>{text}" * 10 + "</div>"
    for rest in ("", links):
        for inner in (one, many):
            got = html_text.main_text(f"<body>{rest}<div class=post><h1>Title</h1><p>Lead</p>{inner}</div></body>").split("\n")
            assert got[:2] == ["Title", "Lead"] and set(got[2:]) == {text.strip()} and len(got) == (3 if inner is one else 12)
    pair = f"<body><div>{text * 6}</div><div>{text}</div></body>"
    assert html_text.main_text(pair) == f"{(text * 6).strip()}\n{text.strip()}"


def test_main_text_keeps_what_only_sounds_like_boilerplate():
    text = "Many words of the text stand here. " * 20
    inner = {
        '<pre><code>x = 1 <span class="token comment"># a note</span></code></pre>': "x = 1 # a note",
        f'<section class="related-work"><h2>Related work</h2><p>{text}</p></section>': f"Related work\n{text.strip()}",
        '<div class="alert"><p>Mind this.</p></div>': "Mind this.",
        '<div class="related-posts"><p>Another post</p></div>': None,
        '<div id="commentList"><p>I liked all of it.</p></div>': None,
    }
    for html, kept in inner.items():
        page = f"<body><nav><a href=x>m</a></nav><article><h1>T</h1><p>{text}</p>{html}<p>{text}</p></article></body>"
        want = ["T", text.strip(), *([kept] if kept else []), text.strip()]
        assert html_text.main_text(page) == "\n".join(want)
    assert html_text.main_text(f'<body><div id="search-trees-article"><h1>T</h1><p>{text}</p></div></body>') == f"T\n{text.strip()}"


@pytest.mark.parametrize("page", ["<i>" * 100000 + "x", "<b><div>" + "<i>" * 50000 + "x</b>" * 50000, "<div>t " * 50000 + "</div>" * 50000])
def test_main_text_of_deep_pages_takes_time_by_length(page):
    began = time.perf_counter()
    assert html_text.main_text(page)
    assert time.perf_counter() - began < 10


def test_main_text_of_planted_pages_without_an_article():
    """Recall and precision by words, over layouts of one text among menus, teasers, notices and comments."""
    dice = random.Random(8)
    hit = found = wanted = 0
    for _ in range(60):
        body = [" ".join(f"w{dice.randrange(500)}" for _ in range(dice.randrange(8, 90))) + "." for _ in range(dice.randrange(4, 14))]
        links = "".join(f"<li><a href=/{i}>Page {i} of many</a>" for i in range(dice.randrange(3, 20)))
        around = [f"<div class=menu><ul>{links}</ul></div>", f"<div><ul>{links}</ul></div>", "<div class=ad><p>Buy it now</p></div>"]
        dice.shuffle(around)
        comments = "<div class=comments><p>" + "A reader says what a reader says. " * 9 + "</p></div>"
        holder = dice.choice(["<div class=post>%s</div>", "<div><div>%s</div></div>", "<table><tr><td>%s</td></tr></table>"])
        page = f"<body>{around[0]}{holder % ''.join(f'<p>{x}</p>' for x in body)}{around[1]}{comments}{around[2]}<div class=footer>(c) us</div></body>"
        got = Counter(html_text.main_text(page).split())
        want = Counter(" ".join(body).split())
        hit, found, wanted = hit + (got & want).total(), found + got.total(), wanted + want.total()
    assert hit >= 0.95 * wanted and hit >= 0.95 * found


def test_main_text_of_several_articles():
    text = "Many words of the text. " * 20
    both = f"<body><div>Unmarked</div><article><p>{text * 5}</article><article><h2>Second</h2><p>{text}</article><article>End</article>"
    assert html_text.main_text(both) == f"{(text * 5).strip()}\nSecond\n{text.strip()}\nEnd"
    apart = f"<body><article><p>Teaser</article><div><p>{text}</p><p>{text}</p></div>"
    assert html_text.main_text(apart) == f"Teaser\n{text.strip()}\n{text.strip()}"


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    vocabulary = [("▁", 0.0)]
    for result in (
        neardup.near_duplicates(none), neardup.without_near_duplicates(none), repeats.repeats(none), mixing.mix(none),
        mixing.curriculum(none), sharding.shards(none), outliers.quality(none), tokens.token_counts(none, vocabulary),
        templates.template_lines(none),
    ):
        assert result.count() == 0
