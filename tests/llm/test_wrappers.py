"""The wrapper decides what of a page is its text; marks are evidence. Brute force: pages made from known articles."""

import random
import time

from sievework.llm import wrappers

from .test_line_dedup import vocabulary


def made(n, inside, seed=1):
    """(html, text) of n pages of one host; `inside` stands in every article under a class that says nothing."""
    rng, words = random.Random(seed), vocabulary(800, 3)
    line = lambda k: " ".join(rng.choice(words) for _ in range(k)).capitalize() + "."
    out = []
    for i in range(n):
        parts = [line(rng.randint(20, 40)) for _ in range(rng.randint(2, 5))]
        body = "".join(f"<p>{p}</p>" for p in parts)
        if i % 4 == 1:
            extra = line(6)
            body = f"<h2>{extra}</h2>" + body
            parts.insert(0, extra)
        out.append((f"<html><body><nav><a href=/>Home</a></nav><article><div class=zz>{inside}</div>{body}</article><footer>end {i}</footer></body></html>", " ".join(parts)))
    return out


def table(spark, pages, url="https://h.example/{}"):
    return spark.createDataFrame([(i, url.format(i), h) for i, h in enumerate(pages)], "page_id long, url string, html string")


def test_text_that_a_host_repeats_within_articles_goes(spark):
    """Fails if marks alone choose the blocks and the wrapper is passed by."""
    pages = made(24, "Read this on our new reader, now free of charge.")
    got = {r.page_id: r.text for r in wrappers.extract_pages(table(spark, [h for h, _ in pages])).collect()}
    assert got == {i: t for i, (_, t) in enumerate(pages)}
    assert "free of charge" in wrappers.extract(pages[0][0])  # without a wrapper it stays


def test_copies_and_single_subheadings_stay(spark):
    pages = [h for h, _ in made(6, "")]
    same = [pages[0]] * 12
    text = made(6, "")[0][1]
    got = {r.page_id: r.text for r in wrappers.extract_pages(table(spark, same)).collect()}
    assert set(got.values()) == {text}  # a host of copies has no frame to take away
    one = [t for _, t in made(6, "")][1]
    assert {r.page_id: r.text for r in wrappers.extract_pages(table(spark, pages)).collect()}[1] == one


def test_marks_are_read_as_they_stand():
    page = "<html><body>{}</body></html>"
    assert wrappers.extract(page.format('<div id="content" class="with-sidebar"><p>Story one.</p></div>')) == "Story one."
    assert wrappers.extract(page.format('<article class="post has-comments"><p>Text of it.</p></article>')) == "Text of it."
    story = "The rest of the story stands outside of that. " * 4
    assert wrappers.extract(page.format(f'<div class="post"><p>Intro.</p></div><p>{story}</p>')) == f"Intro. {story.strip()}"
    assert wrappers.extract(page.format('<div class="sidebar"><p>Aside.</p></div><article><p>Body.</p></article>')) == "Body."


def test_inline_tags_take_linear_time():
    html = "<article><p>" + "<b>x " * 40_000 + "</p></article>"
    start = time.time()
    assert wrappers.extract(html) == " ".join(["x"] * 40_000)
    wrappers.page_wrapper(html)
    assert time.time() - start < 15


def test_wrappers_stay_bounded_and_rows_odd(spark):
    rng = random.Random(4)
    state = {}
    pages = [f"<body>{''.join(f'<div class=k{rng.randrange(10**6)}x{j}><i>t{i}</i></div>' for j in range(30))}<p>common {i}</p></body>" for i in range(200)]
    wrappers._fold_hosts((("h", 1, wrappers.page_wrapper(p)) for p in pages), state)
    assert len(state["h"][1]) < 5000
    odd = spark.createDataFrame([(1, None, None), (1, "x", ""), (2, "https://a/b", "<p>" + "long " * 50_000), (None, "https://a/c", "no tags")], "page_id long, url string, html string")
    got = sorted(((r.page_id, r.n_chars) for r in wrappers.extract_pages(odd).collect()), key=str)
    assert got == sorted([(1, 0), (1, 0), (2, 249_999), (None, 7)], key=str)
    assert wrappers.extract_pages(odd.limit(0)).count() == 0


def rare(n, seed=7):
    """n pages of one host: two hold most of its text, in blocks of classes that no other page has; the others a line at their end."""
    rng = random.Random(seed)
    classes = [f"k{''.join(random.Random(j).choices('abcdefghij', k=9))}" for j in range(1000)]
    word = lambda k: "".join(rng.choice("abcdefghij") for _ in range(k))
    out = []
    for i in range(n):
        parts = [" ".join(word(6) for _ in range(12)) for _ in range(1000)] if i in (0, 40) else [word(7)]
        body = "".join(f"<div class={c}>{p}</div>" for c, p in zip(classes, parts, strict=False))
        out.append(f"<html><body><div class=wrap>{body}</div><div class=last>{' '.join(word(6) for _ in range(12))}</div></body></html>")
    return out


def test_pruned_options_keep_their_weight(spark):
    """Options that a large wrapper gives up still tell where the host keeps its text."""
    pages = rare(110)
    state, spilled = {}, []
    wrappers._fold_hosts((("h", 1, wrappers.page_wrapper(h)) for h in pages), state, spilled)
    left = list(wrappers.slots(state["h"][1]))
    assert spilled and wrappers.container(state["h"][1]).endswith("<div.last>")  # what is left alone would tell
    assert sum(x[3] for x in left) + sum(x[4] for x in spilled) == sum(x[3] for h in pages for x in wrappers.slots(wrappers.page_wrapper(h)))
    found = table(spark, pages).select("*", wrappers.host_of().alias("host"))
    row = wrappers._whole_summaries(*wrappers.infer_wrappers(found)).first()
    told = wrappers.json.loads(row.summary)
    assert told["pages"] == 110 and told["container"].endswith("<div.wrap>")
    got = {r.page_id: r.n_chars for r in wrappers.extract_pages(table(spark, pages)).collect()}
    assert got[0] > 80_000 and got[40] > 80_000
