import random

from ledgerloom.llm import html


def pages(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "1 AS host", "2 AS token", "3 AS main", "4 AS text") if extra else df


def got(df):
    rows = html.extract(df).collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    return {r.page_id: r.text for r in rows}


def words(r, n):
    return " ".join(r.choice(["alpha", "beta", "gamma", "delta", "épsilon"]) + str(r.randint(0, 99)) for _ in range(n))


def article(r, i):
    head, body = words(r, 4), [words(r, r.randint(3, 40)) for _ in range(r.randint(1, 6))]
    page = (f"<!doctype html><html><head><title>{head}</title><style>p {{}}</style><script>var t='</p><article>';</script></head><body>"
            f"<header><h1>Site</h1></header><nav><ul><li><a href='/{i}'>{words(r, 1)}</a></ul></nav><div class='cookie-notice'>We use cookies</div>"
            f"<div class='ad'>{words(r, 5)}</div><article class=post id=p{i}><h1>{head} &amp; more</h1>"
            + "".join(f"<p>\n  {b.replace(' ', chr(10), 1)}&nbsp;<b>x</b><br>y" + ("</p>" if r.random() < 0.7 else "") for b in body)
            + f"<form>Name <input></form><section class='comments'><p>{words(r, 9)}</p></section></article>"
            f"<aside>{words(r, 6)}</aside><!-- > <p>no --><footer>&copy; {words(r, 3)}</footer>" + ("</body></html>" if i % 2 else ""))
    return page, "\n\n".join([f"{head} & more", *(f"{b} x y" for b in body)])


def test_articles_of_a_host(spark):
    r = random.Random(0)
    made = {i: article(r, i) for i in range(60)}
    rows = [(i, f"http://h{i % 3}.example.com/{i}", page) for i, (page, _) in made.items()]
    assert got(pages(spark, rows, extra=True)) == {i: text for i, (_, text) in made.items()}


def test_a_single_page(spark):
    page, text = article(random.Random(1), 1)
    assert got(pages(spark, [(1, "http://one.example.com/", page)])) == {1: text}


def test_template_without_marks(spark):
    """No element names the article: what the pages share is the template, what differs is content."""
    r = random.Random(2)
    rows, want = [], {}
    for i in range(30):
        body = words(r, 30)
        rows.append((i, "http://plain.example.com/", f"<body><div class=top>Welcome to our site</div><div class=x><p>{body}</div>"
                     f"<div class=y><a href=/a>{words(r, 2)}</a> <a href=/b>{words(r, 2)}</a></div><div class=z>All rights reserved</div>"))
        want[i] = body
    assert got(pages(spark, rows)) == want


def test_repeated_article_text_stays(spark):
    rows = [(i, "http://same.example.com/", "<article><p>Licensed text.</p><p>Same.</article>") for i in range(10)]
    assert set(got(pages(spark, rows)).values()) == {"Licensed text.\n\nSame."}


def test_template_text_inside_articles(spark):
    """A notice without a telling class name, in every article of a host; another host's pages differ by a counter alone."""
    r = random.Random(3)
    rows, want = [], {}
    for i in range(20):
        body = [words(r, r.randint(8, 20)) for _ in range(2)]
        rows.append((i, "http://noted.example.com/", f"<article><div class=q>Tell your friends</div><p>{body[0]}</p><p>Read on below.</p>"
                     f"<p>{body[1]}</p></article>" if i else f"<p>{body[0]}</p>"))
        want[i] = "\n\n".join(body) if i else body[0]
        rows.append((100 + i, "http://equal.example.com/", f"<article><p>One text that all pages hold.</p><p>{i} views</p></article>"))
        want[100 + i] = f"One text that all pages hold.\n\n{i} views"
    assert got(pages(spark, rows)) == want


def test_optional_containers_without_marks(spark):
    """Lists, tables and nested elements that only some pages hold, and a layout on under 5 % of the host's pages."""
    r = random.Random(4)
    rows, want = [], {}
    for i in range(60):
        parts = [words(r, 20) for _ in range(4)]
        lists = [(f"<ul><li>{parts[1]}</li><li><a href=/>{parts[2]}</a></li></ul>", parts[1:3]), (f"<table><tr><td>{parts[1]}</td></tr></table>", parts[1:2]),
                 (f"<div class=v><div class=w>{parts[3]}</div></div>", parts[3:])]
        some = [x for x in lists if r.random() < 0.4]
        links = f"<div class=y><a href=/a>{words(r, 2)}</a></div>"
        if i < 2:
            rows.append((i, "http://plain.example.com/", f"<body><div class=top>Welcome</div><div class=rare><p>{parts[0]}</p>{lists[0][0]}</div>"
                         f"<div class=links><a href=/a>{words(r, 2)}</a></div>{links}<div class=z>All rights</div>"))
            some = lists[:1]
        else:
            rows.append((i, "http://plain.example.com/", f"<body><div class=top>Welcome</div><div class=content><p>{parts[0]}</p>"
                         f"{''.join(x for x, _ in some)}</div>{links}<div class=z>All rights</div>"))
        want[i] = "\n\n".join([parts[0], *(t for _, ts in some for t in ts)])
    assert got(pages(spark, rows)) == want


def test_names_are_evidence_not_a_verdict(spark):
    """Listed words on elements that hold the article, on the article itself, and in compounds inside it."""
    r = random.Random(6)
    one, two, other = words(r, 30), words(r, 25), words(r, 6)
    rest = f"<p>{one}</p><p>{two}</p>"
    made = [
        f"<body class='has-sidebar'><article>{rest}</article></body>",
        f"<html class='js cookie-consent'><body><article>{rest}</article></body></html>",
        f"<body class='single comments-open'><div class='sidebar'>{other}</div><main>{rest}</main></body>",
        f"<article class='post notice-2021'>{rest}</article>",
        f"<form id=aspnet><div class=ad>{other}</div><article>{rest}</article></form>",
        f"<article><section class='alert-system'>{rest}</section></article>",
        f"<div class='widget page'><nav>{other}</nav><article>{rest}</article></div>",
        f"<body><form id=all>{rest}</form><div class='footer'>{other}</div></body>",
        f"<article>{rest}</article><aside><article>{other}</article></aside>",
        f"<article>{rest}</article><div class='related-posts'><article>{other}</article></div>",
        f"<article>{rest}<section class='comments-area'><article>{other * 40}</article></section></article>",
        f"<article>{rest}</article><div class='comments'><article>{other * 40}</article></div>",
        f"<article>{rest}<div class='notice extra-word'>{other}</div></article>",
    ]
    rows = [(i, f"http://h{i}.example.com/", page) for i, page in enumerate(made)]
    assert got(pages(spark, rows)) == {i: f"{one}\n\n{two}" for i in range(len(made))}


def brute_same(rows):
    """For each host the texts that every page with an article holds in its article, if they are half of it at most."""
    out = {}
    for host in {html.host_of(u) for _, u, _ in rows}:
        own = []
        for _, u, page in rows:
            if html.host_of(u) == host:
                read = [b for b in html.blocks(page) if b[0] == 1 and not b[4] and b[3]]
                if read:
                    own.append({(b[1], b[5]): sum(len(x[5]) for x in read if (x[1], x[5]) == (b[1], b[5])) for b in read})
        same = set.intersection(*map(set, own)) if len(own) >= html.MIN_PAGES else set()
        if sum(n for page in own for k, n in page.items() if k in same) <= html.SAME_SHARE * sum(n for page in own for n in page.values()):
            out[host] = same
    return out


def test_article_templates_against_brute_force(spark):
    """Notices that some, all but one, or all pages of a host hold, hosts of 1 to 12 pages."""
    r = random.Random(8)
    rows = []
    for host in range(12):
        notes = [words(r, r.choice([3, 40])) for _ in range(3)]
        for i in range(host + 1):
            held = [n for k, n in enumerate(notes) if k == 0 or (k == 1 and i) or (k == 2 and r.random() < 0.5)]
            rows.append((100 * host + i, f"http://b{host}.example.com/", "<article>" + "".join(
                f"<div class=q>{n}</div>" for n in held) + f"<p>{words(r, r.choice([5, 60]))}</p></article>"))
    same = brute_same(rows)
    want = {}
    for i, u, page in rows:
        drop = same.get(html.host_of(u), set())
        want[i] = "\n\n".join(b[5] for b in html.blocks(page) if b[0] == 1 and (b[1], b[5]) not in drop)
    assert got(pages(spark, rows)) == want
    assert sum(bool(x) for x in same.values()) > 4


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "http://a/", "   "), (4, "http://a/", "plain < text & more &lt;b&gt; &amp"),
            (5, "http://a/", "<article>a<p>b<div>c</article>"), (6, "http://a/", "<p>" + "long " * 50_000), (7, "x", "<" * 20_000),
            (8, "http://a/", "<script>" * 3000 + "x"), (9, "http://a/", "<a '" * 3000), (10, "http://a/", "<div>" * 3000 + "deep"),
            (11, "http://a/", "<p title='a>b'>in</p><!-- open"), (12, "http://a/", "<nav>menu</nav>"), (None, "http://a/", "<p>no id</p>"),
            (13, "http://a/", "<head><title>t</title><p>body without end of head")]
    out = got(pages(spark, rows, extra=True))
    assert [out[i] for i in (1, 2, 3, 12)] == [""] * 4
    assert out[4] == "plain < text & more <b> &" and out[5] == "a\n\nb\n\nc" and out[6] == ("long " * 50_000).strip()
    assert out[10] == "deep" and out[11] == "in" and out[None] == "no id" and out[8] == ""
    assert got(pages(spark, [])) == {}
