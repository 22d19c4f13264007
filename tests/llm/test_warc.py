import base64
import hashlib
import json
from html.parser import HTMLParser

from brute import rows, with_clashes
from tidelog.llm import warc

PAGES = [
    (1, "http://a.com/", "<html><head><title>A &amp; B</title><style>p{}</style></head><body><p>One<br>two <b>bo</b>ld<script>var x='</p>'</script><a href='/l?a=1&amp;b=2'>li<i>n</i>k</a></p><!-- no <p> --><div>end"),
    (2, None, None), (3, "http://b.com/", ""), (4, "x", "plain < text > and & more &lt;"), (4, "x", "plain < text > and & more &lt;"), (None, "y", "<p>unclosed <a href=x <b>é日本</b> <img src=\"p.png\">"),
    (5, "z", "<script>never closed " + "x" * 100_000), (6, "w", "<a " * 20_000), (7, "v\r\nInjected: 1", "<p>t"),
]


def derived(spark):
    pages = with_clashes(spark.createDataFrame(PAGES, "page_id long, url string, html string"), "record_id", "headers", "content")
    return warc.derive(warc.responses(pages)), warc.responses(pages)


def test_records_refer_to_their_response(spark):
    found, responses = derived(spark)
    source = {(r["page_id"], r["record_id"]): r for r in responses.collect()}
    records = found.collect()
    assert len(records) == 2 * len(PAGES)
    ids = {r["record_id"]: r for r in records}
    for r in records:
        origin = source[r["page_id"], r["refers_to"]]
        body = bytes(origin["block"]).partition(b"\r\n\r\n")[2]
        sha1 = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
        assert (r["target_uri"], r["warc_date"]) == (origin["target_uri"], origin["warc_date"])
        assert r["payload_digest"] == sha1(body) and r["block_digest"] == sha1(bytes(r["content"])) and r["content_length"] == len(r["content"])
        assert ids[r["concurrent_to"]]["refers_to"] == r["refers_to"] and ids[r["concurrent_to"]]["warc_type"] != r["warc_type"]


def test_text_title_and_links():
    text, title, links = warc.read_html(PAGES[0][2])
    assert text == "A & B\nOne\ntwo boldlink\nend" and title == "A & B"
    assert links == [{"path": "A@/href", "url": "/l?a=1&b=2", "text": "link"}]
    assert warc.read_html("a<br>b &lt;c&gt;<td>d")[0] == "a\nb <c>\nd"


class Plain(HTMLParser):
    """Words of a page by the standard parser."""

    def __init__(self):
        super().__init__()
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attributes):
        self.hidden += tag in ("script", "style")
        self.out.append("\n" if tag in warc._BLOCK else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        self.out.append("\n" if tag in warc._BLOCK else "")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def test_pages_against_the_standard_parser(spark, sf_dir):
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        parser = Plain()
        parser.feed(r["html"])
        lines = [" ".join(line.split()) for line in "".join(parser.out).split("\n")]
        assert warc.read_html(r["html"])[0] == "\n".join(line for line in lines if line)


def test_other_responses(spark):
    block = lambda kind, body: b"HTTP/1.1 200 OK\r\nContent-Type: " + kind + b"\r\nX-A: b: c\r\n\r\n" + body
    made = [warc.derive_one("<urn:uuid:1>", "u", "d", {"WARC-IP-Address": "1.2.3.4"}, b) for b in (block(b"image/png", b"\x89PNG"), block(b"text/plain; charset=latin-1", b"caf\xe9"), b"", block(b"text/html; charset=nonsense", "é".encode()))]
    assert [[r[1] for r in each] for each in made] == [["metadata"], ["metadata", "conversion"], ["metadata"], ["metadata", "conversion"]]
    assert made[1][1][-1] == "café".encode() and made[3][1][-1] == "é".encode()
    told = json.loads(made[0][0][-1])
    assert told["WARC-Header"]["WARC-IP-Address"] == "1.2.3.4" and ["X-A", "b: c"] in told["HTTP-Response"]["Headers"]


def test_serialized_records_read_back(spark):
    found, _ = derived(spark)
    for r in warc.serialized(found).collect():
        headers, content = warc.parse_record(bytes(r["record"]))
        assert content == bytes(r["content"]) and headers["WARC-Refers-To"] == r["refers_to"] and headers["WARC-Block-Digest"] == r["block_digest"]
        assert "Injected" not in headers


def test_empty_table(spark):
    assert warc.derive(warc.responses(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0
