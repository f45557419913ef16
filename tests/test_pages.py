"""Markup that real pages contain: nesting, unclosed cells, entities, scripts."""

import random

from ledgerline.operators import extract, html

MESSY = """<html><script>var t = "</td>";</script><table>
<tr><th class="I">Fonctions<tr><td class="QL x">Administrateur:<td>0400.000.001<td>Depuis le 1
<tr><td>G&eacute;rant</td><td><table><tr><td>a</td><td>b</td></tr></table></td></tr>
<tr><td>Depuis le 3</td><td>x</td></tr>
<tr><td class="I">Onderlinge betrekkingen</td></tr><tr><td>Geen gegevens</td></tr><tr><td>0400.000.002&nbsp;(ACME) fusie</td></tr>
</table><a>no target</a><li>un <b>acte</b> <a href="/tsv_pdf/2020/01/02/9.pdf">x</a></li></html>"""


def pages(spark, text=MESSY):
    return spark.createDataFrame([("1", 1, text), ("2", 1, None), ("3", 1, "")], "num string, page int, html string")


def test_rows_and_sections(spark):
    rows = html.page_rows(pages(spark))
    got = {r["row_no"]: [c["text"] for c in r["cells"]] for r in rows.collect()}
    assert got[1] == ["Administrateur:", "0400.000.001", "Depuis le 1"]
    assert got[2] == ["Gérant", "a b"] and got[3] == ["a", "b"]
    titled = extract.with_section(rows)
    officers = {(r["fonction"], r["nom"]) for r in extract.officers(titled).collect()}
    assert officers == {("Administrateur:", "0400.000.001"), ("Gérant", "a b"), ("a", "b")}
    rel = [(r["bce"], r["nom"]) for r in extract.relations(titled).collect()]
    assert rel == [("0400000002", "ACME")]


def test_labels(spark):
    got = {r["label"]: r["val"] for r in extract.label_values(html.page_rows(pages(spark))).collect()}
    assert got["Administrateur"] == "0400.000.001 Depuis le 1"


def test_links(spark):
    links = html.page_links(pages(spark))
    assert [(r["href"], r["block_text"]) for r in links.collect()] == [("/tsv_pdf/2020/01/02/9.pdf", "un acte x")]
    pub = extract.publications(links).first()
    assert (pub["numac"], pub["date"], pub["pdf_url"]) == ("9", "2020-01-02", "https://www.ejustice.just.fgov.be/tsv_pdf/2020/01/02/9.pdf")


def test_last_page(spark):
    df = spark.createDataFrame([("?page=3 &page=12",), ("none",), ("?page=999",)], "h string")
    assert [r[0] for r in df.select(extract.last_page(df["h"])).collect()] == [12, 1, 999]


def test_a_page_without_labels_is_still_a_record(spark):
    officer = '<table><tr><td class="I">Fonctions</td></tr><tr><td>Administrateur</td><td>Dupont</td></tr></table>'
    pages = spark.createDataFrame([("1", 1, officer), ("2", 1, ""), ("3", 1, None)], "num string, page int, html string")
    got = {r["num"]: r for r in extract.card_records(pages, html.page_rows(pages), html.page_links(pages)).counts().collect()}
    assert {n: r["fonctions"] for n, r in got.items()} == {"1": 1, "2": 0, "3": 0}
    assert got["1"]["generalites"]["numero"] is None and got["1"]["archive"] == "/kbopub/1.html"


def test_unclosed_tags_do_not_multiply(spark):
    page = html.Page("<div><b>" * 3000 + "x</i>" * 3000 + "</b></div>")
    assert page.depth["div"] == 0 and len(page.elements) == 6000


MARKUP = """<p><A HREF="/a?x=1&amp;y=2">one</a> <a class='k' href='/b "q"'>two</a><a name="n">none</a><a href=/c>three</a>
<!-- <a href="/no">x</a> --><script>var s = '<a href="/no">';</script><abbr href="/no">x</abbr><a title="a > b" href="/d&#233;&#x20AC;&unknown;">four</a><a
 data-href="/no" href="">empty</a></p>"""


def test_link_targets_without_python_are_those_of_the_parser(spark):
    from ledgerline.operators import links

    df = spark.createDataFrame([("1", 1, MARKUP), ("2", 1, None), ("3", 1, ""), ("4", 2, "<p>no links</p>")], "num string, page long, html string")
    want = sorted((r["num"], r["page"], r["link_no"], r["href"]) for r in html.page_links(df).collect())
    got = links.link_targets(df)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 5
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString() and "MapInArrow" not in got._jdf.queryExecution().executedPlan().toString()


def test_rows_and_links_come_from_one_parse(spark):
    items = html.page_items(pages(spark))
    both = html.rows_of(items).select("num", "page").unionByName(html.links_of(items).select("num", "page"))
    assert items._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert both.count() == html.page_rows(pages(spark)).count() + html.page_links(pages(spark)).count()
    empty = spark.createDataFrame([("1", 1, None), ("2", 1, "")], "num string, page long, html string")
    assert html.page_items(empty).collect() == []


PIECES = [
    "<td>", "</td>", "<tr>", "</tr>", "<table>", "</table>", '<a href="/x?a=1&amp;b=2">', "<a href=/c>", "<a href=c/>", """<a class='k' href='/b "q"'>""",
    '<a href="x&copy=1">', "</a>", "<li>", "</p >", '</p class="x">', "<br/>", '<img src="a>b"/>', "text", "a & b", "&eacute;", "&amp", "<", "a < b", "<!-- c -->",
    "<!--->", "<!-- a -- b -->", "<!DOCTYPE html>", "<?php x ?>", "<script>", "</script>", "</ script>", '<script src="a">var t="</p>";', "<title>", "</title>",
    '<TD CLASS="I QL">', '<td class="a" class="b">', "<div>", "</div>", "<a href = 'y'>", '<a href="u', "'", ">", "<td/>", "\xa0", "</>",
]


class Parsed(html.Page):
    """A page that is always left to HTMLParser."""

    def _scan(self, text):
        return False


def outcome(page):
    return [(e["tag"], e["attrs"], e["start"], e["end"]) for e in page.elements], page.texts, html._rows(page)


def test_scan_of_plain_markup_gives_what_the_parser_gives():
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 14)))
        assert outcome(html.Page(text)) == outcome(Parsed(text)), text


def test_plain_pages_need_no_parser(monkeypatch):
    calls = []
    monkeypatch.setattr(html.Page, "feed", lambda self, text: calls.append(text))
    page = html.Page('<!DOCTYPE html><title>a &amp; b</title><script>if (a < b) t="</p>";</script><!-- ad --><table><tr><td class="QL">G&eacute;rant<td>x</table><a href="/p?a=1&amp;b=2">l</a>')
    assert not calls and html._rows(page) == [[("td", "QL", "Gérant"), ("td", "", "x")]] and page.elements[-1]["attrs"] == {"href": "/p?a=1&b=2"}
