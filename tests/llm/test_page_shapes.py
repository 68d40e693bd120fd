"""Pages in which nothing but their shape tells the article from its surroundings."""

import pytest

from caudal.llm import html_extract

P = "Long paragraph text about the works of the council in the city, which goes on for a while and tells what was done."
ARTICLE = f"<h1>The title</h1><p>{P}</p><p>{P} {P}</p>"
TEXT = f"The title\n{P}\n{P} {P}"


@pytest.fixture(scope="module")
def model():
    return html_extract.train(html_extract.labelled_pages())


@pytest.mark.parametrize(
    "body",
    [
        f'<table><tr><td><a href="/a">Home</a><br><a href="/b">News</a><br><a href="/c">Sports</a></td><td>{ARTICLE}</td></tr></table>',
        f'<table><tbody><tr><td>{ARTICLE}</td><td><p><a href="/a">Other story</a></p><p><a href="/b">One more</a></p></td></tr></tbody></table>',
        f'<article>{ARTICLE}</article><div id="respond"><div><b>Ana</b><p>Very nice works, thanks.</p></div><div><b>Luis</b><p>I do not agree with it at all.</p></div><div><b>Eva</b><p>When does it open?</p></div></div>',
        f'<main>{ARTICLE}</main><section><div><span>Ana</span><p>Nice.</p></div><div><span>Luis</span><p>No.</p></div></section>',
        f'<div id="main-content">{ARTICLE}</div><div id="rail"><h3>More</h3><p><a href="/x">Other story</a></p><p>Weather today</p></div>',
        f'<div><div id="left"><ul><li><a href="/x">One</a></li><li><a href="/y">Two</a></li></ul></div><div class="content">{ARTICLE}</div></div>',
        f'<article>{ARTICLE}</article><form><p>Sign up</p><button>Send</button></form>',
    ],
)
def test_surroundings_without_names(model, body):
    assert html_extract.extract(f"<html><body>{body}</body></html>", model) == TEXT


def test_what_stays(model):
    page = f"<html><body><article><h1>The title</h1><p>Press the <button>Start</button> key to begin. {P}</p><table><tr><td>Year</td><td>Cost</td></tr><tr><td>2024</td><td>12</td></tr></table><p>{P}</p></article></body></html>"
    assert html_extract.extract(page, model) == f"The title\nPress the Start key to begin. {P}\nYear\nCost\n2024\n12\n{P}"
    page = f'<html><body><nav><a href="/">Home</a></nav><main><section><h2>One</h2><p>{P}</p></section><section><h2>Two</h2><p>{P}</p></section><section><h2>Three</h2><p>Short end.</p></section></main><footer>Copyright</footer></body></html>'
    assert html_extract.extract(page, model) == f"One\n{P}\nTwo\n{P}\nThree\nShort end."
