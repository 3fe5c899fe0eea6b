"""Pages of any length teach the block labeller."""

import numpy as np

from nodepulse.llm import html_blocks


def page(n):
    body = "".join(f"<p>Sentence {k} of a long article, with words enough to be one.</p>" for k in range(n))
    return f"<html><body><nav><a href=1>Home</a></nav><article>{body}</article><footer><p>All rights</p></footer></body></html>"


def test_long_pages_teach(spark):
    rows = [(k, "u", page(600 + k)) for k in range(12)]
    assert all(len(h) > 30_000 for _, _, h in rows)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = html_blocks.train(pages)
    assert not np.array_equal(model.w["o"], html_blocks.BlockLabeller().w["o"])
    for r in html_blocks.main_text(pages, model).collect():
        assert r.text.startswith("Sentence 0 ") and "All rights" not in r.text and "Home" not in r.text
    ends = [html_blocks.lessons(h) for _, _, h in rows]
    place = html_blocks.PATH + html_blocks.WORDS + 5
    assert max(e[0][0][:, place].max() for e in ends) <= 0.25 and max(x[:, place].max() for e in ends for x, _ in e) > 0.8
    assert all(len(e) == (1 + html_blocks.BUILT) * html_blocks.WINDOWS for e in ends)


def test_no_page_to_learn_from(spark):
    none = spark.createDataFrame([(1, "u", "<script>x</script>"), (2, "u", None)], "page_id long, url string, html string")
    model = html_blocks.train(none)
    want = "\n".join(f"Sentence {k} of a long article, with words enough to be one." for k in range(2))
    assert model.extract([page(2), None]) == ([want, ""], [len(want), 0])
