"""The chain field, line quality, HTML extraction and the pipeline."""

import itertools

import numpy as np
import pytest
from shopperflow.llm import crf, html_blocks, line_quality

from .conftest import prose


def scores_of_all(chain, features):
    out = {}
    for labels in itertools.product((0, 1), repeat=len(features)):
        emit = sum((features[i] @ chain.weights) for i, y in enumerate(labels) if y)
        out[labels] = emit + sum(chain.steps[a, b] for a, b in itertools.pairwise(labels))
    return out


@pytest.fixture()
def chain():
    return crf.Chain(np.array([0.7, -1.1]), np.array([[0.3, -0.4], [-0.9, 0.8]]))


def test_marginals_and_viterbi_against_all_labellings(chain):
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 6, 2])
    x = rng.normal(size=(12, 2))
    marginals, best = chain.marginals(x, lengths), chain.viterbi(x, lengths)
    for end, n in zip(np.cumsum(lengths), lengths):
        all_scores = scores_of_all(chain, x[end - n : end])
        z = sum(map(np.exp, all_scores.values()))
        for i in range(n):
            assert marginals[end - n + i] == pytest.approx(sum(np.exp(s) for y, s in all_scores.items() if y[i]) / z)
        assert tuple(best[end - n : end]) == max(all_scores, key=all_scores.get)


def test_fit_follows_the_gradient(chain):
    rng = np.random.default_rng(2)
    x, lengths = rng.normal(size=(60, 2)), np.array([4] * 15)
    y = (x[:, 0] - x[:, 1] > 0).astype(int)

    def likelihood(c):
        total = 0
        for i in range(15):
            part = scores_of_all(c, x[4 * i : 4 * i + 4])
            total += part[tuple(y[4 * i : 4 * i + 4])] - np.log(sum(map(np.exp, part.values())))
        return total - 0.5 * ((c.weights**2).sum() + (c.steps**2).sum())

    fitted = crf.fit(x, y, lengths, rounds=800, rate=0.05)
    at = likelihood(fitted)
    for i in range(2):
        for d in (-0.05, 0.05):
            w = fitted.weights.copy()
            w[i] += d
            assert likelihood(crf.Chain(w, fitted.steps)) < at + 1e-3
    for i, j in itertools.product(range(2), range(2)):
        s = fitted.steps.copy()
        s[i, j] += 0.05
        assert likelihood(crf.Chain(fitted.weights, s)) < at + 1e-3


# --- line quality


def labelled_rows(n):
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        text = "\n".join(prose(10 * i + k, 12 + k) for k in range(4))
        rows.append((i, text if good else text.upper().replace(" ", "!! ") if i % 2 else "\n".join(["spam ### $$$ &&&"] * 6)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_learns_and_is_whole(spark, docs, varied):
    rows, labels = labelled_rows(120)
    known = spark.createDataFrame([*labels, (5, 0, 1), (9999, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = line_quality.learn(docs(*rows), known.where("doc_id < 90 or doc_id is null or doc_id > 1000"))
    out = {r.doc_id: r for r in line_quality.scored(docs(*rows), model).collect()}
    assert all((out[i].predicted == 1) == bool(q) for i, q, _ in labels if i >= 90)
    assert all(0 <= r.score <= 1 for r in out.values())
    again = line_quality.scored(varied, model)
    assert again.count() == varied.count() and again.where("score is null or score < 0 or score > 1 or isnan(score)").count() == 0
    same = {r.score for r in line_quality.scored(varied.where("doc_id in (1, 2)"), model).collect()}
    assert len(same) == 1  # null and empty
    assert line_quality.scored(docs(), model).collect() == []


def test_quality_without_labels(spark, docs):
    model = line_quality.learn(docs((1, "a")), spark.createDataFrame([], "doc_id long, quality int"))
    assert line_quality.scored(docs((1, "a b\nc"), (2, None)), model).toPandas()["score"].tolist() == [0.5, 0.5]


def test_quality_learns_from_bounded_whole_documents(spark, docs):
    rows, labels = labelled_rows(60)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = line_quality.learn(docs(*rows), known, most_documents=30, most_lines=80)
    assert model.chain.weights.any()


@pytest.mark.parametrize("long", [[7], [1, 2, 3], list(range(60))])
def test_quality_learns_beside_oversized_documents(spark, docs, long):
    rows, labels = labelled_rows(90)
    known = spark.createDataFrame([x for x in labels if x[0] < 60], "doc_id long, quality int, toxic int")
    grown = [(i, "\n".join([t] * 40) if i in long else t) for i, t in rows]
    model = line_quality.learn(docs(*grown), known, most_lines=120 if len(long) == 60 else 300)
    out = {r.doc_id: r.predicted for r in line_quality.scored(docs(*rows[60:]), model).collect()}
    assert np.mean([out[i] == q for i, q, _ in labels[60:]]) > 0.9


def test_lines_are_shared_out():
    sizes, times = np.array([1, 4, 10, 900]), np.array([3, 2, 2, 1])
    for most in (8, 9, 20, 37, 50, 930, 931, 932, 5000):
        share = line_quality.shared(sizes, times, most)
        given = lambda k: (np.minimum(sizes, k) * times).sum()
        assert given(share) <= most and (given(share + 1) > most or share >= 900)
    assert line_quality.shared(sizes, times, 3) == 1 and line_quality.shared(sizes[:0], times[:0], 5) == 5


def test_quality_on_held_out_rows(spark, sf_dir):
    from shopperflow.llm.queries import op6_line_quality

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    seen = op6_line_quality(spark, sf_dir).join(labels, "doc_id").where("held_out").toPandas()
    good, bad = seen[seen.quality == 1].score.to_numpy(), seen[seen.quality == 0].score.to_numpy()
    if len(good) and len(bad):
        assert (good[:, None] > bad).mean() > 0.9


# --- pages

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="<p>no</p>";</script></head><body>
<header class="site"><a href="/">Home of it all</a></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies so that this site remembers you and works as you expect it to.</p></div>
<article><h1>A &amp; B&nbsp;together</h1><p>The first   paragraph of
the article has <b>several</b> words &#8211; and <a href="x">a link</a>.</p><p>Short.
<div class="advert">Buy this wonderful thing now, it is cheaper than it ever was before.</div>
<p>The last paragraph of the article is here, and it ends.</p>
<section id="comments"><p>I think this is all wrong, and I have said so before, many times.</p></section></article>
<aside><h3>More</h3><p>Another story that you may like to read when you are done with this one.</p></aside>
<form><p>Sign up to hear from us every single day of the week.</p></form><!-- <p>no</p> -->
<footer><p>All rights reserved by the people who wrote all of this.</p></footer></body></html>"""


def test_article_text():
    chain = html_blocks.fitted()
    text = html_blocks.main_text([PAGE], chain)[0]
    assert text == (
        "A & B together The first paragraph of the article has several words – and a link. Short. "
        "The last paragraph of the article is here, and it ends."
    )


@pytest.mark.parametrize("name", ['class="overflow-hidden"', 'class="hidden-xs"', 'data-title="Hidden gems"', "data-hidden=1", "title='display:none'", 'hidden="false"',
                                  'aria-hidden="false"', 'data-note="aria-hidden=true"', 'style="background:url(x?display:none)"', 'data-x=">" class=hidden-xs'])
def test_only_hidden_elements_are_left_out(name):
    assert [b.text for b in html_blocks.blocks(f"<div {name}><p>Shown.</p></div><p>Next.</p>")] == ["Shown.", "Next."]


@pytest.mark.parametrize("name", ["hidden", 'hidden=""', "HIDDEN=hidden", 'class="a" hidden id=b', 'aria-hidden="true"', "aria-hidden=true", 'style="color:red; DISPLAY : none"', "style=display:none",
                                  "title='a>b' hidden"])
def test_hidden_elements_are_left_out(name):
    assert [b.text for b in html_blocks.blocks(f"<div {name}><p>Not shown.</p></div><p>Next.</p>")] == ["Next."]


@pytest.mark.parametrize("name", sorted(html_blocks._UNSEEN))
def test_unclosed_elements_leave_the_page(name):
    rest = [] if name in ("script", "style") else ["Next."]
    assert [b.text for b in html_blocks.blocks(f"<p>One.</p><{name} a=b><p>Next.</p>")] == ["One.", *rest]
    assert [b.text for b in html_blocks.blocks(f"<p>One.</p><{name} a=b><b>no</b></{name} ><p>Next.</p>")] == ["One.", "Next."]
    if name not in html_blocks._RAW:
        assert [b.text for b in html_blocks.blocks(f"<{name}><p>One.</p><{name}>no</{name}><p>Next.</p>")] == ["One.", "Next."]
        assert [b.text for b in html_blocks.blocks(f"<{name}>no<{name}>no</{name}>no</{name}><p>Next.</p>")] == ["Next."]


def test_many_unclosed_elements_take_one_scan():
    assert len(html_blocks.blocks("<map><p>x</p>" * 30_000)) == 30_000


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "<<<>>>"), (4, "u", "<p>" * 500 + "deep"), (5, "u", PAGE[:900]), (6, "u", PAGE * 30), (7, "u", "<script>never closed"),
            (8, "u", "<p class='a>b' title=\"x>y\">Quoted attributes are no text at all, as we see here.</p>"), (9, None, "plain words, and no tag"), (1, "u", None)]
    pages = spark.createDataFrame([(*r, "other") for r in rows], "page_id long, url string, html string, text string")
    out = html_blocks.extracted(pages).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    by_id = {r.page_id: r.text for r in out}
    assert by_id[1] == by_id[2] == by_id[7] == "" and "x>y" not in by_id[8] and "b'" not in by_id[8]
    assert html_blocks.extracted(pages.limit(0)).collect() == []


def test_held_out_pages():
    """Other pages from the same layouts, and the chain fitted on half of them."""
    from shopperflow.llm.labelled_pages import labelled

    right = total = 0
    for page in labelled(400)[240:]:
        found = html_blocks.blocks(page)
        gold = np.array([b.text.startswith("\x01") for b in found])
        for b in found:
            b.text = b.text.replace("\x01", "") or "x"
        right += (html_blocks.fitted().viterbi(html_blocks.features(found), np.array([len(found)])) == gold).sum()
        total += len(found)
    assert right / total > 0.97


# --- pipeline


def test_pipeline_against_its_parts(spark, sf_dir):
    import re

    import corpus_pipeline as pipeline
    from shopperflow.llm import piece_lattice, pseudonyms
    from shopperflow.llm.queries import KEY, model_file

    from .test_ngram_join import brute
    from .test_text_operators import hits

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = documents
    for number, (_, stage) in enumerate(pipeline.STAGES[:4]):
        before = docs
        docs = pipeline.settle(stage(spark, before, sf_dir))
        assert docs.columns == documents.columns and docs.dtypes == documents.dtypes
        old = {r.doc_id: r.text for r in before.collect()}
        new = {r.doc_id: r.text for r in docs.collect()}
        if number == 1:
            assert set(new) == {c for i, _, c in brute(list(old.items())) if i == c}
        elif number == 2:
            items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            assert set(new) == {i for i, t in old.items() if not hits(t, items)[4]}
        elif number == 3:
            tool = pseudonyms.Pseudonyms(KEY)
            assert new == {i: tool.text(t)[0] for i, t in old.items()}
            assert all(r.n_chars == len(r.text) for r in docs.collect())
            assert not any(re.search(r"\+1 \(\d{3}\) 555-", t) and re.search(r"\+1 \(\d{3}\) 555-", old[i]) and t == old[i] for i, t in new.items())
    model = piece_lattice.Pieces(model_file())
    out = {r.doc_id: r.ids for r in pipeline.run(spark, sf_dir).collect()}
    assert {i: model.decode(ids) for i, ids in out.items()} == new


def test_pipeline_stages_take_any_rows(spark, sf_dir, varied):
    import corpus_pipeline as pipeline

    odd = varied.withColumn("n_chars", varied.n_words.cast("long"))
    for _, stage in pipeline.STAGES:
        out = stage(spark, odd, sf_dir)
        assert out.count() <= odd.count()
        if "ids" not in out.columns:
            assert out.dtypes == odd.dtypes
        assert stage(spark, odd.limit(0), sf_dir).count() == 0
    kept = dict(pipeline.STAGES)["near_copies"](spark, odd, sf_dir).where("doc_id is not null")
    assert kept.count() == kept.select("doc_id", "text").distinct().count()


def test_unlike_texts_of_one_id_stay(spark, sf_dir, docs):
    import corpus_pipeline as pipeline

    near_copies = dict(pipeline.STAGES)["near_copies"]
    rows = [(1, "One two three four five six."), (1, "Wholly other text is here now."), (1, "one two three four five six."), (2, "wholly other text is here now.")]
    for _ in range(2):
        kept = near_copies(spark, docs(*rows).repartition(3), sf_dir).select("doc_id", "text").collect()
        assert len(kept) == 2 and {r.doc_id for r in kept} == {1} and len({r.text.lower() for r in kept}) == 2
    maps = docs((5, "a b c d e f"), (5, "a b c d e f"), (6, "other")).selectExpr("*", "map('k', lang) AS m", "1 AS `a.b`")
    assert near_copies(spark, maps, sf_dir).count() == 2
