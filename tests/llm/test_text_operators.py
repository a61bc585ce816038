import html
import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from moorage.llm import decontam, html_text, licenses, quality_ledger, secret_scan, toxicity

# ---- licences


def plain_words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def test_phrase_places(documents):
    for row in licenses.scan(documents).join(documents.select("doc_id", "text"), "doc_id").collect():
        words = plain_words(row["text"])
        want = sorted(
            (i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        )
        assert [(p["start_word"], p["label"]) for p in row["places"]] == want and row["n_words"] == len(words)


def test_automaton_finds_longest_matches():
    draw = random.Random(1)
    texts = [[draw.randrange(4) for _ in range(draw.randint(1, 30))] for _ in range(5)]
    machine = licenses.Automaton(texts)
    runs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for _ in range(200):
        words = [draw.randrange(5) for _ in range(25)]
        want, length = [], 0
        ends = []
        for i in range(len(words)):
            length = next((n for n in range(length + 1, 0, -1) if n <= i + 1 and tuple(words[i + 1 - n : i + 1]) in runs), 0)
            ends.append(length)
        want = [(i + 1, n) for i, n in enumerate(ends) if n >= 2 and (i + 1 == len(words) or ends[i + 1] != n + 1)]
        found = machine.matches(words, 2)
        assert [(end, n) for end, n, _ in found] == want
        for end, n, state in found:
            places = {(t, p) for t, text in enumerate(texts) for p in range(n - 1, len(text)) if text[p + 1 - n : p + 1] == words[end - n : end]}
            assert machine.ends[state] == places


def test_template_spans(spark):
    scanner = licenses.Scanner()
    mit = licenses.TEMPLATES[2][1]
    words = mit.split()
    edited = " ".join(["Intro", *words[:40], "oddly", *words[42:], "outro words"])
    spans = scanner.spans(scanner.words(edited))
    assert {s.label for s in spans} == {"mit"} and max(s.share for s in spans) > 0.8
    assert scanner.spans(scanner.words("the software and the license of this work is free")) == []


def test_dropped_words_keep_a_span():
    scanner = licenses.Scanner()
    text = " ".join(w.decode() for w in licenses.plain_words(licenses.TEMPLATES[2][1]))
    for phrase in ("and to permit persons to whom the software ", "of charge to any person obtaining a copy "):
        assert phrase in text
        text = text.replace(phrase, "", 1)
    spans = [s for s in scanner.spans(scanner.words(text)) if s.template == 2]
    assert [(s.label, s.start, s.end, s.covered) for s in spans] == [("mit", 0, 69, 69)]
    twice = [s for s in scanner.spans(scanner.words(f"{text} one two {text} odd")) if s.template == 2]
    assert [(s.start, s.end, s.covered) for s in twice] == [(0, 69, 69), (71, 140, 69)]


def brute_chain(scanner, words, template):
    """Most words that a chain covers: all pairs of all longest common runs."""
    own = scanner.templates[template][1]
    runs = []
    for i in range(len(words)):
        for j in range(len(own)):
            if words[i] == own[j] and not (i and j and words[i - 1] == own[j - 1]):
                n = 0
                while i + n < len(words) and j + n < len(own) and words[i + n] == own[j + n]:
                    n += 1
                if n >= scanner.least:
                    runs.append((i, j, n))
    runs.sort(key=lambda run: (run[0] + run[2], run[1] + run[2]))
    best = []
    for i, j, n in runs:
        most = n
        for (a, b, m), before in zip(runs, best):
            skip = max(0, a + m - i, b + m - j)
            if skip < n and i + skip - a - m <= scanner.gap and j + skip - b - m <= scanner.gap:
                most = max(most, before + n - skip)
        best.append(most)
    return max(best, default=0)


def test_edited_templates_against_brute_force():
    draw = random.Random(8)
    scanner = licenses.Scanner()
    for _ in range(150):
        number = draw.randrange(len(scanner.templates))
        words = list(scanner.templates[number][1])
        for _ in range(draw.randint(0, 6)):
            at = draw.randrange(len(words))
            kind = draw.randrange(3)
            if kind == 0 and len(words) > 12:
                del words[at : at + draw.randint(1, 8)]
            elif kind == 1:
                words[at:at] = [draw.choice([-1, *words]) for _ in range(draw.randint(1, 6))]
            else:
                words[at] = -1
        found = {}
        for span in scanner.spans(licenses.np.array(words, licenses.np.int32)):
            found[span.template] = max(found.get(span.template, 0), span.covered)
        for template, (_, own) in enumerate(scanner.templates):
            most = brute_chain(scanner, words, template)
            assert found.get(template, 0) == (most if most >= scanner.share * len(own) else 0)


def test_license_odd_rows(odd, nothing):
    rows = licenses.scan(odd).collect()
    assert len(rows) == odd.count() and licenses.scan(nothing).count() == 0
    assert [len(r["places"]) for r in rows if r["doc_id"] == 1] == [2, 2]


# ---- quality ledger


def test_ablations(documents):
    book = quality_ledger.ledger(documents)
    rows = {r["rule"]: r for r in quality_ledger.ablations(book, "3").collect()}
    failed = [r["failed"] for r in book.collect()]
    for bit, rule in enumerate(quality_ledger.RULES):
        assert rows[rule]["n_failed"] == sum(f >> bit & 1 for f in failed)
        assert rows[rule]["n_only"] == sum(f == 1 << bit for f in failed)
    assert quality_ledger.mask("2") == 0b1111


# ---- toxicity


@pytest.fixture(scope="module")
def talk(spark):
    draw = random.Random(2)
    plain = ["".join(draw.choice(["ba", "ke", "lo", "mi", "ru", "ten", "sor"]) for _ in range(draw.randint(1, 4))) for _ in range(300)]
    rows, labels = [], []
    for i in range(800):
        words = [draw.choice(plain) for _ in range(draw.randint(20, 120))]
        if toxic := i % 4 == 0:
            for _ in range(1 + len(words) // 25):
                words.insert(draw.randrange(len(words)), draw.choice(["wretchling", "wretchkin", "vilespawn", "vilecrow"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy_and_unseen_spellings(spark, talk):
    docs, labels = talk
    model = toxicity.train(docs, labels, steps=60, buckets=1 << 14)
    found = toxicity.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 100
    assert sum(r["predicted"] == r["toxic"] for r in found) / len(found) > 0.95
    score = model.scorer()
    base = "bake lomi ru ten sor " * 6
    assert score([base + "wretchlings vilespawnn"])[0] > 0.5 > score([base])[0]
    assert score([base + "keru"]) == score([base + "keru"])


@pytest.mark.parametrize("n_terms,n_toxic,n_clean", [(100, 500, 500), (10, 90, 2910)])
def test_rare_spellings_and_a_rare_class(n_terms, n_toxic, n_clean):
    """A hundred terms, each in 1 % of the toxic texts; and a toxic class of 3 %."""
    draw = random.Random(3)
    terms = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(n_terms)]
    plain = ["".join(draw.choice(["ba", "ke", "lo", "mi", "ru", "ten", "sor"]) for _ in range(draw.randint(1, 4))) for _ in range(300)]

    def text(term):
        words = [draw.choice(plain) for _ in range(draw.randint(20, 120))]
        for _ in range(1 + len(words) // 25 if term else 0):
            words.insert(draw.randrange(len(words)), term)
        return " ".join(words)

    model = toxicity.fit(
        [text(terms[i % n_terms]) for i in range(n_toxic)] + [text(None) for _ in range(n_clean)], [1] * n_toxic + [0] * n_clean
    )
    scores = model.scorer()
    assert sum(s >= 0.5 for s in scores([text(term) for term in terms])) >= 0.95 * n_terms
    assert sum(s >= 0.5 for s in scores([text(None) for _ in range(200)])) <= 10


def test_held_out_rows_are_never_learned(talk):
    docs, labels = talk
    texts, classes = toxicity.training_rows(docs, labels, key="doc_id", text="text", label="toxic", max_rows=1000, max_chars=10**7)
    held = {r["text"] for r in docs.where(toxicity.held_out(F.col("doc_id"))).collect()}
    assert texts and not held & set(texts) and set(classes) == {0, 1}


def test_training_goes_on_after_a_text_that_does_not_fit(spark):
    sizes = [(i, "x" * (3 if i % 5 else 1)) for i in range(400)]
    docs = spark.createDataFrame(sizes, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS toxic")
    texts, classes = toxicity.training_rows(docs, labels, key="doc_id", text="text", label="toxic", max_rows=1000, max_chars=101)
    for value in (0, 1):
        assert sum(len(t) for t, c in zip(texts, classes) if c == value) == 101


def test_toxicity_odd_rows(odd, nothing, talk):
    model = toxicity.train(*talk, steps=5, buckets=1 << 10)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.score(odd, None).where("score = 0 and predicted = 0").count() == odd.count()
    assert toxicity.train(nothing, talk[1]) is None
    assert toxicity.reject(odd, model).columns == odd.columns


# ---- secrets


def test_base_rules(documents, odd):
    def plain(text):
        text, found = text or "", []
        for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII):
            found += [("assign", *m.span())] * (len(m[2]) >= 12)
        found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))

    for docs in (documents, odd):
        rows = docs.select("text").collect()
        assert any(plain(r["text"]) for r in rows)
        for r in rows:
            assert [s[:3] for s in secret_scan.base_spans(r["text"] or "")] == plain(r["text"])


def test_grammar_accepts_unseen_credentials():
    draw = random.Random(4)
    key = lambda: "sk-" + "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(24))
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(16, 24)))
    judge = secret_scan.Judge([key() for _ in range(200)], [word() for _ in range(300)])
    assert secret_scan.Grammar([secret_scan.symbols(key()) for _ in range(200)]).states < 60
    assert all(judge.score(key()) > judge.threshold for _ in range(50))
    assert sum(judge.score(word()) > judge.threshold for _ in range(200)) <= 2
    text = f"plain words {word()} then {key()}."
    assert [s.kind for s in secret_scan.scan_text(text, judge)] == ["format"]


def test_secret_odd_rows(odd, nothing):
    judge = secret_scan.learn(odd)
    rows = secret_scan.scan(odd, judge).collect()
    assert len(rows) == odd.count() and secret_scan.scan(nothing, secret_scan.learn(nothing)).count() == 0
    kinds = [s["kind"] for r in rows if r["doc_id"] == 12 for s in r["spans"]]
    assert kinds == ["assign", "hex", "access", "hex"]


# ---- pages


def page(body, article=True):
    body = f"<article>{body}</article>" if article else f"<div id=content>{body}</div>"
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a<b) x='</p>';</script></head><body>"
        "<header><a href=/>Site name</a></header><nav><ul><li><a href=/a>Menu one</a></li><li><a href=/b>Menu two</a></ul></nav>"
        '<div class="ad">Buy now and save much money</div><div class="cookie-notice">We use cookies here</div>'
        f"{body}<aside>Related posts to read</aside><div id=comments><p>First comment by a reader of this</p></div>"
        "<form><label>Mail</label><input name=m><button>Send</button></form><footer>&copy; all rights</footer></body></html>"
    )


@pytest.mark.parametrize("article", [True, False])
def test_main_text(spark, article):
    counts = Counter()
    for _ in range(20):
        counts.update({})
    weights = html_text.weights(html_text.tag_counts(page("<h1>A b c</h1><p>word " * 9)))
    text = "<h1>Title &amp; <em>more</em></h1><p>First  line\n of <b>bold</b> &lt;text&gt; here.<p>Second <a href=x>link</a> paragraph, and more words in it.</p>"
    assert html_text.main_text(page(text, article), weights) == (
        "Title & more\nFirst line of bold <text> here.\nSecond link paragraph, and more words in it."
    )


@pytest.mark.parametrize("name", ["content has-sidebar", "layout no-sidebar", "ad-free-content", "elementor-widget-container", "widget", "ad"])
@pytest.mark.parametrize("article", [True, False])
def test_wrappers_keep_their_words(name, article):
    weights = html_text.weights(html_text.tag_counts(page("<h1>A b c</h1><p>word " * 9)))
    lines = [f"Paragraph number {i} of the story with quite a few more words in it." for i in range(6)]
    body = "".join(f"<p>{line}</p>" for line in lines)
    made = page(f'<div class="{name}">{body}</div>', article)
    assert html_text.main_text(made, weights) == "\n".join(lines)


def test_parts_of_an_article_with_noise_in_their_names():
    weights = html_text.weights(html_text.tag_counts(page("<h1>A b c</h1><p>word " * 9)))
    text = "Some words of the story that fill a paragraph of their own."
    made = page(
        f'<div class="entry-header"><h1>The title</h1></div><p>{text}</p><div class="ad">Buy this <div>right</div> now</div>'
        f'<div class="widget"><p>A box of the story.</p></div><p>{text}</p>'
    )
    assert html_text.main_text(made, weights) == f"The title\n{text}\nA box of the story.\n{text}"
    assert html_text.main_text("<p>Name</p>" + "<div class=ad>" * 3000 + "more words", weights) == "more words"


def test_round_trip(spark):
    """Texts put into pages come out again."""
    draw = random.Random(9)
    weights = html_text.weights(html_text.tag_counts(page("<h1>A b c</h1><p>word " * 9)))
    for _ in range(100):
        lines = [" ".join(draw.choice(["a<b", "x&y", "word", "ünï", "&amp;", "\"q\""]) for _ in range(draw.randint(1, 30))) for _ in range(draw.randint(1, 9))]
        made = page("".join(f"<p>{html.escape(line)}" + draw.choice(["", "</p>", "<br></p>"]) for line in lines))
        assert html_text.main_text(made, weights) == "\n".join(lines)


def test_best_run_is_best():
    draw = random.Random(6)
    for _ in range(300):
        scores = [draw.randint(-5, 5) for _ in range(draw.randint(0, 12))]
        start, end = html_text.best_run(scores)
        best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0)
        assert sum(scores[start:end]) == max(0, best)


def test_page_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", ""), (2, "u", "<p>unclosed <b>words"), (3, "u", "no tags at all"), (4, "u", "<div>" * 5000 + "deep" + "<p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = html_text.extract(frame, html_text.learn(frame)).collect()
    assert Counter((r["page_id"], r["text"], r["n_chars"]) for r in found) == Counter(
        [(1, "", 0), (1, "", 0), (None, "", 0), (2, "unclosed words", 14), (3, "no tags at all", 14), (4, "deep", 4)]
    )
    assert html_text.extract(frame.where("false"), {}).count() == 0


# ---- decontamination beyond the SQL


@pytest.mark.parametrize("limits", [{"MOST_WINDOWS": 0}, {"MOST_CHARS": 0}, {"MOST_WINDOWS": 0, "MOST_HASHES": 0}])
def test_sets_and_join_agree(spark, documents, odd, monkeypatch, limits):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").unionByName(
        spark.createDataFrame([(900, "quick brown"), (901, "The MIT license")], "item_id long, text string")
    )
    for docs in (documents, odd):
        by_set = sorted(map(str, decontam.inspect(docs, items).collect()))
        left = sorted(map(str, decontam.clean(docs, items, spans=True).collect()))
        for name, value in limits.items():
            monkeypatch.setattr(decontam, name, value)
        assert sorted(map(str, decontam.inspect(docs, items).collect())) == by_set
        assert sorted(map(str, decontam.clean(docs, items, spans=True).collect())) == left
        monkeypatch.undo()


def test_many_windows_are_found_without_shuffling_documents_windows(spark):
    """200,000 windows: more than the plan carries; every planted passage and no other text is hit."""
    items = spark.range(1000).select(
        F.col("id").alias("item_id"), F.expr("array_join(transform(sequence(1, 212), i -> concat('w', id, 'x', i)), ' ')").alias("text")
    )
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.expr("concat('some words before ', if(id % 3 = 0, array_join(transform(sequence(5, 17), i -> concat('w', id, 'x', i)), ' '),"
               " array_join(transform(sequence(5, 16), i -> concat('w', id, 'x', i)), ' ')), ' and after')").alias("text"),
    )
    table, grams = decontam._bounded(items, "item_id", "text", 13)
    assert table.count() == 200_000 and grams is None
    rows = decontam.inspect(docs, items).collect()
    assert all(row["n_hit"] == (13 if row["doc_id"] % 3 == 0 else 0) for row in rows) and len(rows) == 300
    assert all(list(row["items"]) == ([str(row["doc_id"])] if row["n_hit"] else []) for row in rows)
    plan = decontam._candidates(docs, table, "doc_id", "text")._jdf.queryExecution().sparkPlan().toString()
    assert [line for line in plan.splitlines() if "LeftSemi" in line and "BroadcastHashJoin" in line]


def test_clean_removes_documents_or_spans(spark, odd, nothing):
    items = spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string")
    left = decontam.clean(odd, items)
    assert left.columns == odd.columns and left.where("text = 'the quick brown fox'").count() == 0
    assert left.count() == odd.count() - 2
    spans = decontam.clean(odd, items, spans=True)
    assert spans.count() == odd.count() and spans.where("text = 'the'").count() == 2
    assert decontam.clean(nothing, items).count() == 0 and decontam.clean(odd, items.where("false")).count() == odd.count()


def _formats(draw, n):
    """Credentials of five formats."""
    mixed = string.ascii_letters + string.digits
    made = [
        lambda: "sk_live_" + "".join(draw.choices(mixed, k=24)), lambda: "ghp_" + "".join(draw.choices(mixed, k=36)),
        lambda: "".join(draw.choices(string.ascii_lowercase + string.digits, k=32)),
        lambda: "-".join("".join(draw.choices("0123456789abcdef", k=k)) for k in (8, 4, 4, 4, 12)),
        lambda: "".join(draw.choices(mixed + "+/", k=43)) + "=",
    ]
    return [draw.choice(made)() for _ in range(n)]


def test_bare_credentials_of_known_formats_are_found(spark, documents):
    """Learned from assignments; measured on unseen values without one, and on the ordinary strings of the documents."""
    draw = random.Random(5)
    known, unseen = _formats(draw, 300), _formats(draw, 300)
    plain = [row["text"] for row in documents.collect()]
    texts = plain + [f'token = "{value}"' for value in known]
    judge = secret_scan.learn(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5))
    found = [[(s.kind, s.value) for s in secret_scan.scan_text(f"see {value}.", judge) if s.kind != "hex"] for value in unseen]
    assert sum(spans == [("format", value)] for spans, value in zip(found, unseen)) >= 0.95 * len(unseen)
    words = [s.value for text in plain for s in secret_scan.scan_text(text, secret_scan._Everything()) if s.kind == "format"]
    wrong = [s.value for text in plain for s in secret_scan.scan_text(text, judge) if s.kind == "format"]
    assert len(words) > 500 and len(wrong) <= 0.01 * len(words)


def test_grammars_and_threshold_come_from_every_string(spark):
    """More values and strings than any sample held, over many tasks: all are counted, and the threshold is that of all scores."""
    draw = random.Random(8)
    keys = _formats(draw, 1500) + ["A" * 100 + "7" * 30, "A" * 100 + "b7" * 15]
    words = list({"".join(draw.choices("aeinrstz", k=draw.randint(12, 20))) for _ in range(5000)})
    texts = [f'token = "{key}"' for key in keys * 2] + words + words[:900] + [f"token={words[0]}", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    found = secret_scan.formats(docs).cache()
    bases = {s.value for text in texts for s in secret_scan.base_spans(text or "")}
    assert found.where("good = 1").agg(F.sum("n")).first()[0] == len(bases) and len(bases) > 1500
    assert found.where("good = 0").agg(F.sum("n")).first()[0] == len(set(words) - bases)
    for strings, states in ((bases, 400), (set(words) - bases, 10**6)):
        steps = secret_scan._steps(found.where(f"good = {int(strings is bases)}"))
        built = []
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(secret_scan.Grammar, "counted", lambda nodes, rest: built.append((nodes, rest)))
            secret_scan._counted(steps, states)
        (nodes, rest), = built
        kinds = [value.translate(secret_scan._KIND) for value in strings]
        wanted = Counter((kind[:k] if k < secret_scan.DEPTH else None, min(k, secret_scan.DEPTH), (kind + "$")[k])
                         for kind in kinds for k in range(len(kind) + 1))
        assert len(nodes) <= states and all(prefix[:-1] in nodes for prefix in nodes)
        for prefix, counts in nodes.items():
            assert +counts == Counter({mark: n for (held, _, mark), n in wanted.items() if held == prefix})
        for length, counts in enumerate(rest):
            others = Counter()
            for (held, size, mark), n in wanted.items():
                others[mark] += n * (size == length and held not in nodes)
            assert +counts == +others
    judge = secret_scan.learn(docs, states=200, threshold=-99.0, false_share=0.1)
    scores = [judge.score(word) for word in set(words) - bases]
    allowed = int(0.1 * len(scores))
    assert 0.98 * allowed <= sum(score > judge.threshold for score in scores) <= allowed
    assert judge.threshold in scores


def test_one_odd_word_doesn_t_move_the_threshold():
    draw = random.Random(2)
    keys = ["".join(draw.choices(string.ascii_letters + string.digits, k=24)) for _ in range(300)]
    words = ["".join(draw.choices("aeinrst", k=draw.randint(12, 20))) for _ in range(2000)]
    even = secret_scan.Judge(keys[:200], words)
    odd_one = secret_scan.Judge(keys[:200], [*words, "aQwErTyUiOpLkJhGfDsAzXcV"])
    for judge in (even, odd_one):
        assert judge.threshold < 1 and all(judge.score(key) > judge.threshold for key in keys[200:])
    # The length of a format is part of it.
    assert max(map(even.score, keys[200:])) > even.score(keys[200][:13]) and min(map(even.score, keys[200:])) > even.score(keys[0] * 9)


def test_candidates_touching_base_spans_in_linear_time():
    import time

    text = " ".join(f"token={'z' * 12}{i:04d} {'word' * 3}{i:04d}" for i in range(8000))
    judge = secret_scan._Everything()
    start = time.perf_counter()
    spans = secret_scan.scan_text(text, judge)
    assert time.perf_counter() - start < 1.5
    assert Counter(s.kind for s in spans) == {"assign": 8000, "format": 8000}
    plain = [m for m in secret_scan.CANDIDATE.finditer(text[:5000])]
    base = [s for s in secret_scan.base_spans(text[:5000])]
    clear = [m.span() for m in plain if not any(s.start < m.end() and m.start() < s.end for s in base)]
    assert [(s.start, s.end) for s in secret_scan.scan_text(text[:5000], judge) if s.kind == "format"] == clear


def test_sample_is_that_of_the_whole_table(spark):
    values = [f"{'value' * 3}{i:05d}" for i in range(900)]
    whole = secret_scan.Smallest(50)
    for value in values * 2:
        whole.add(value)
    parts = secret_scan.Smallest(50)
    for start in range(0, 900, 90):
        part = secret_scan.Smallest(50)
        for value in values[start : start + 90]:
            part.add(value)
        for value, _ in part.found():
            parts.add(value)
    assert whole.found() == parts.found() and len(whole.found()) == 50


CONTENT_WRAPPERS = [
    "content has-sidebar", "layout no-sidebar", "ad-free-content", "elementor-widget-container", "entry-header", "card hidden md:block",
    "post-body", "text-block", "row", "article__lead", "address", "adaptive", "commentary", "headerless", "socialism", "shareholders",
    "notice", "widget", "post-header", "readable",
]
NOISE_WRAPPERS = [
    "ad", "ad-container", "ad-slot", "ad-unit", "adsbygoogle", "comments-area", "comment-list", "comment-body", "post-comments",
    "related-posts", "share-buttons", "newsletter-box", "promo-box", "social-links", "cookie-bar", "sidebar", "adSlot", "ad_wrapper_2",
    "breadcrumbs", "cookie-notice",
]


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<div class=page>{}</div>"])
def test_wrappers_by_name(frame):
    """Content stays and noise goes, inside a marked article and without one."""
    words = "<p>" + " ".join(f"Plain{i}" for i in range(80)) + ".</p>"
    kept = {name: html_text.main_text(frame.format(f'{words}<div class="{name}">Part of it here.</div>{words}'), {}) for name in CONTENT_WRAPPERS + NOISE_WRAPPERS}
    assert [name for name in CONTENT_WRAPPERS if "Part of it here." not in kept[name]] == []
    assert [name for name in NOISE_WRAPPERS if "Part of it here." in kept[name]] == []
    assert all(text.count("Plain0 ") == 2 for text in kept.values())


@pytest.mark.parametrize(
    "tag, stays",
    [
        ('<p title="the hidden cost of things">', True), ('<p class="card hidden md:block">', True),
        ('<p style="overflow: hidden ; x:1">', True), ("<p data-hidden=1>", True), ("<p data-x=it's>", True), ("<p title='a > b'>", True),
        ('<p title="5 = 6" data-y = "x>y">', True), ('<p "odd>', True), ("<p hidden>", False), ('<p id=a hidden="">', False),
        ("<p HIDDEN=until-found>", False), ("<p aria-hidden=true>", False),
    ],
)
def test_attributes_by_the_rules(tag, stays):
    page = f"<article><p>First one here.</p>{tag}Text one here.</p><p>don't lose this.</p><p>Text three.</p></article>"
    lines = ["First one here.", *["Text one here."] * stays, "don't lose this.", "Text three."]
    assert html_text.main_text(page, {}) == "\n".join(lines)
