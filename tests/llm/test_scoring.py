"""Quality rules, classifier, URL filter and licence scan against plain Python."""

import re
import textwrap

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from tableloom.llm import byte_cnn, fertility, licenses, url_rules
from tableloom.llm.queries import HOST_RULES, PIECES
from tableloom.llm.words import PIECE_BYTES, in_pieces

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_repeats(text):
    words, places = WORD.findall(text), {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    return len({i + k for found in places.values() if len(found) > 1 for i in found for k in range(8)})


def test_rules_equal_plain_counts(odd_documents):
    texts = [r.text or "" for r in odd_documents.collect()]
    texts += ["x y z " * 30, "a\nb\na\n\n\na b", "one two three four five six seven eight " * 2 + "# | <"]
    made = fertility.judge(pa.array(texts), PIECES, fertility.BANDS)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for i, text in enumerate(texts):
        words = WORD.findall(text)
        assert made["n_words"][i] == len(words)
        assert made["word_chars"][i] == sum(map(len, words))
        assert made["n_symbols"][i] == len(re.findall(r"[#*$%&|<>]", text))
        assert made["n_repeat_words"][i] == plain_repeats(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert made["n_dup_lines"][i] == len(lines) - len(set(lines))
        ids = [t for w in words for t in model.encode(w)]
        assert made["n_tokens"][i] == len(ids)
        if ids:
            share = np.unique(ids, return_counts=True)[1] / len(ids)
            assert abs(made["token_entropy"][i].as_py() + (share * np.log2(share)).sum()) < 1e-9
            assert made["byte_share"][i].as_py() == sum(map(model.is_byte, ids)) / len(ids)


def test_rules_without_any_window_of_words():
    for texts in ([], [None], ["short"], ["", None, "a b c"]):
        made = fertility.judge(pa.array(texts, pa.string()), PIECES, fertility.BANDS)
        assert list(made["n_words"]) == [len(WORD.findall(t or "")) for t in texts]
        assert not made["n_repeat_words"].any() and not made["kept"].any()


def test_rules_on_odd_rows(odd_documents, no_documents):
    rows = fertility.fertility(odd_documents, PIECES).collect()
    assert len(rows) == 10
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (4, 5, None))
    assert all(r.kept for r in rows if r.doc_id in (1, 2, 3))
    assert fertility.fertility(no_documents, PIECES).count() == 0
    kept = fertility.keep_by_rules(odd_documents, PIECES)
    assert kept.columns == odd_documents.columns
    assert kept.where("doc_id = 3").count() == 2


def test_scripts():
    assert fertility.script_of("straße") == "latin"
    assert fertility.script_of("привет мир") == "cyrillic"
    assert fertility.script_of("漢字") == "han"
    assert fertility.script_of("123") == "other"


def test_network_learns_and_covers_every_byte():
    draw = np.random.default_rng(1)
    good = [b" ".join(draw.choice([b"sun", b"sea", b"sand"], 200)) for _ in range(60)]
    bad = [b" ".join(draw.choice([b"sun", b"s#$%", b"!!SAND"], 200)) for _ in range(60)]
    network = byte_cnn.train(good + bad, [1] * 60 + [0] * 60)
    made = byte_cnn.scores(network, good + bad)
    assert ((made >= 0.5) == ([True] * 60 + [False] * 60)).mean() > 0.95
    again = byte_cnn.train(good + bad, [1] * 60 + [0] * 60)
    assert all((a == b).all() for a, b in zip(network.arrays(), again.arrays(), strict=True))
    for size in (0, 1, 128, 129, 1024, 1025, 5000):
        starts = byte_cnn.chunk_starts(size)
        assert starts[0] == 0 and starts[-1] + byte_cnn.CHUNK >= size
    long = b"x" * 200_000
    one = byte_cnn.probability(network, byte_cnn.text_features(network, long)[None])
    assert abs(byte_cnn.scores(network, [b"a", long])[1] - one[0]) < 1e-6


def test_gradients_equal_differences():
    network = byte_cnn.untrained(3)
    network.bytes_[256] = 0
    network.filter_bias[:] = 0.1  # away from the bend at 0, where padding lies
    data, targets = [b"abc def ghi " * 100, b"#$% xyz" * 20], np.array([1.0, 0.0])

    def loss():
        p = byte_cnn.scores(network, data)
        return -np.mean(targets * np.log(p) + (1 - targets) * np.log(1 - p))

    found = byte_cnn.gradients(network, data, targets)
    for array, gradient in zip(network.arrays(), found, strict=True):
        place = np.unravel_index(np.abs(gradient).argmax(), array.shape)
        held, step = array[place], np.float32(1e-3)
        array[place] = held + step
        up = loss()
        array[place] = held - step
        down = loss()
        array[place] = held
        assert abs((up - down) / 2e-3 - gradient[place]) < 0.05 * abs(gradient[place]) + 1e-4


def test_without_labels_scores_are_the_share(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    network = byte_cnn.fit(odd_documents, labels)
    rows = byte_cnn.classify(odd_documents, network).collect()
    assert len(rows) == 10 and all(r.score == 0.5 and r.predicted == 1 for r in rows)
    assert byte_cnn.classify(no_documents, network).count() == 0
    assert byte_cnn.keep_good(odd_documents, network).count() == 10


def plain_url(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:cut].translate(url_rules.LOWER), rest[cut:]
        path = re.split("[?#]", rest)[0]
    fits = [
        r for r in HOST_RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    if rule:
        return host, path, rule.name, rule.verdict
    low = (url or "").translate(url_rules.LOWER)
    for pattern in url_rules.PATTERN_RULES:
        if re.search(pattern.pattern, low):
            return host, path, None, pattern.verdict
    return host, path, None, "allow"


def test_urls_equal_all_rules_on_every_url(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    odd = [
        (-1, None), (-2, ""), (-3, "no scheme/casino"), (-4, "http://A.Example.COM/en/x?y"),
        (-5, "http://net"), (-6, "http://x.net/es/?a#b"), (-7, "ftp://www.example.com/en/#c"),
        (-8, "http://mirror7.org"), (-9, "http://x.org/a/LOGIN"), (-10, "http://casino.org"),
        (-11, "http://x.org?PHPSESSID=0a"), (-12, "http://xnet/es/"), (-12, "http://xnet/es/"),
    ]
    every = pages.union(spark.createDataFrame(odd, "page_id long, url string"))
    made = url_rules.filter_urls(every, "page_id", "url", HOST_RULES).collect()
    given = {r.page_id: r.url for r in every.collect()}
    assert len(made) == every.count()
    for r in made:
        assert (r.host, r.path, r.rule, r.verdict) == plain_url(given[r.page_id]), given[r.page_id]


def test_pattern_index_files_under_the_rarest_literal():
    rule = url_rules.PatternRule("r", "block", r"\bcheap-pills\b")
    index = url_rules.PatternIndex([rule], {(0, "cheap"): 5, (0, "pills"): 2})
    assert list(index.by_literal) == [(url_rules.WHOLE, "pills")]


def test_literals_of_parsed_patterns():
    w, start, end, inside = range(4)
    found = {
        r"\bcheap-pills\b": [{(w, "cheap"), (w, "pills")}],
        r"casino": [{(inside, "casino")}],
        r"/casino": [{(start, "casino")}],
        r"casino\.": [{(end, "casino")}],
        r"//mirror[0-9]*\.": [{(w, "mirror")}, {(start, "mirror")}],
        r"\b(?:a|bc)\b": [{(w, "a")}, {(w, "bc")}],
        r"\b(online-)?casino\b": [{(w, "casino")}, {(w, "online"), (w, "casino")}],
        r"/(.*/)?login\b": [{(w, "login")}] * 3,
        r"free[-/]x{2,}y?$": [{(end, "free"), (start, "x")}, {(end, "free"), (start, "x"), (end, "y")}],
        r"[a-z]+": [set()],
        r"a|[0-9]+": [{(inside, "a")}, set()],
    }
    for pattern, wanted in found.items():
        assert url_rules.literals(pattern) == wanted, pattern
    with pytest.raises(ValueError):
        url_rules.PatternIndex([url_rules.PatternRule("any", "block", "x|[0-9]+")], {})


def test_thousands_of_rules_meet_few_urls():
    rnd = np.random.default_rng(9)
    words = ["".join(rnd.choice(list("abcdefg"), rnd.integers(2, 6))) for _ in range(1500)]
    shapes = [
        r"\b{a}-{b}\b", r"//[^/]*\b({a}-)?{b}\b", r"/{a}[0-9]*\.", r"{a}{b}", r"[?&]{a}=({b}|{a}x)",
        r"/(.*/)?{a}\b", r"{a}\.(com|net)/{b}?", r"^https?://{a}", r"{a}s?$", r"\b{a}.?{b}", r"({a}|{b})+-x",
    ]
    rules = [
        url_rules.PatternRule(f"r{i}", "block", shapes[i % len(shapes)].format(a=rnd.choice(words), b=rnd.choice(words)))
        for i in range(3000)
    ]
    urls = [
        "http://" + "".join(rnd.choice([*words, "-", "/", ".", "?", "=", "com", "12", "_", "é"], rnd.integers(1, 9)))
        for _ in range(300)
    ]
    known = {one for held in url_rules.literals_of(rules).values() for options in held for one in options}
    counts = {}
    for url in urls:
        for one in url_rules.Literals(known).of(url):
            counts[one] = counts.get(one, 0) + 1
    index = url_rules.PatternIndex(rules, counts)
    compiled = [re.compile(rule.pattern, re.DOTALL) for rule in rules]
    run = matches = 0
    for url in urls:
        fits = [i for i, pattern in enumerate(compiled) if pattern.search(url)]
        met = index.candidates(url)
        assert set(fits) <= set(met), url
        assert index.first(url) == (rules[fits[0]] if fits else None)
        run, matches = run + len(met), matches + len(fits)
    assert matches > 100 and run < 0.02 * len(rules) * len(urls)


def plain_license(text):
    low = (text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER))
    words = re.findall(licenses.WORD, low)
    starts, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        starts += found
        base |= {label} if found else set()
    labels, score = set(base), 0.0
    for line in low.split("\n"):
        held = set(re.findall(licenses.WORD, line))
        for label, template in licenses.TEMPLATES.items():
            wanted = set(licenses.template_words(template))
            share = len(held & wanted) / len(wanted)
            if share >= licenses.CONTAINMENT:
                labels.add(label)
                score = max(score, share)
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if base else score,
    )


def test_licenses_equal_plain_search(spark, folder, odd_documents, no_documents):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    extra = [
        (-1, "Permission granted, free of charge, to any person obtaining a copy of this\nsoftware"),
        (-2, "the mit license was released under"),
        (-3, "Permission is hereby granted free of charge to any person obtaining a copy of this software files"),
        (-4, "cc by cc by"), (-5, "cc"), (-6, "all rights\nreserved mit"),
    ]
    every = docs.union(spark.createDataFrame(extra, "doc_id long, text string"))
    every = every.union(odd_documents.select("doc_id", "text").where("doc_id <> 3 or doc_id is null")
                        .selectExpr("coalesce(-100 - doc_id, -200)", "text"))
    given = {r.doc_id: r.text for r in every.collect()}
    made = licenses.scan_licenses(every).collect()
    assert len(made) == len(given)
    for r in made:
        assert tuple(r)[1:] == plain_license(given[r.doc_id]), given[r.doc_id]
    assert licenses.scan_licenses(odd_documents).count() == 10
    assert licenses.scan_licenses(no_documents).count() == 0
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECES


def plain_wrapped_license(text):
    """Labels and best share of templates over all lines and all runs of words."""
    low = text.translate(str.maketrans(licenses.UPPER, licenses.LOWER))
    every, found = re.findall(licenses.WORD, low), {}
    for label, template in licenses.TEMPLATES.items():
        wanted = licenses.all_template_words(template)
        runs = [every[i : i + len(wanted)] for i in range(len(every))]
        blocks = runs + [re.findall(licenses.WORD, line) for line in low.split("\n")]
        found[label] = max(len(set(b) & set(wanted)) / len(set(wanted)) for b in blocks)
    found = {label: share for label, share in found.items() if share >= licenses.CONTAINMENT}
    return ",".join(sorted(found)), max(found.values(), default=0.0)


def test_licenses_survive_wrapping(spark):
    bsd = (
        "Redistribution and use in source and binary forms, with or without\n"
        "modification, are permitted provided that the following conditions are\nmet:"
    )
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
        'of this software and associated documentation files (the "Software"), to deal'
    )
    whole, draw = " ".join(licenses.TEMPLATES.values()), np.random.default_rng(4)
    texts = [bsd, mit, "\n".join(f" * {x}\r" for x in f"{bsd}\n\n{mit}".split("\n")), "of the and in to " * 50]
    for width in (20, 40, 75):
        texts += ["// " + "\n// ".join(textwrap.wrap(t, width)) for t in licenses.TEMPLATES.values()]
        texts.append(" \u2028\n\n".join(textwrap.wrap(whole, width)))
    for gap in range(2, 9):  # templates with words left out, doubled or put between
        kept = [w for i, w in enumerate(whole.split()) if i % gap]
        texts.append("\n".join(" ".join(kept[i : i + 5]) for i in range(0, len(kept), 5)))
        texts.append("\n".join(f"{w} x" if i % gap == 0 else w for i, w in enumerate(whole.split())))
    texts += [" \n".join(draw.permutation(t.split() * 2)) for t in licenses.TEMPLATES.values()]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = {r.doc_id: r for r in licenses.scan_licenses(rows, phrases={"none such": "none"}).collect()}
    assert len(made) == len(texts)
    for i, text in enumerate(texts):
        assert (made[i].labels, made[i].score) == plain_wrapped_license(text), text
    assert (made[0].labels, made[1].labels, made[2].labels) == ("bsd", "mit-grant", "bsd,mit-grant")


def test_licenses_run_no_python(odd_documents):
    plan = licenses.scan_licenses(odd_documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def lambdas(plan):
    """Texts of the lambda functions of a plan."""
    for begin in re.finditer(r"lambdafunction\(", plan):
        depth, at = 1, begin.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(plan[at], 0)
            at += 1
        yield plan[begin.end() : at]


def test_license_texts_are_split_once_and_outside_of_lambdas(spark, odd_documents):
    sets = {label: licenses.template_words(t) for label, t in licenses.TEMPLATES.items()}
    lengths = {label: len(licenses.all_template_words(t)) for label, t in licenses.TEMPLATES.items()}
    rank = {word: i for i, word in enumerate(sorted({w for held in sets.values() for w in held}))}
    kept = odd_documents.selectExpr("doc_id AS row", "text AS kept")
    hits = licenses.template_hits(kept, sets, rank, lengths, 0.8)
    for made in (hits, licenses.line_blocks(kept, rank), licenses.run_matches(hits)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all") == 1
        assert not any("regexp_extract_all" in one for one in lambdas(plan))


def test_licenses_without_templates(spark):
    rows = spark.createDataFrame([(1, "cc by x"), (2, "y")], "doc_id long, text string")
    made = licenses.scan_licenses(rows, templates={}).orderBy("doc_id").collect()
    assert [(r.labels, r.score) for r in made] == [("cc-by", 1.0), ("", 0.0)]


def test_pieces_hold_every_row_once_in_order():
    listed = [None, "", "a" * (2 * PIECE_BYTES), "b", None, "c" * PIECE_BYTES, ""]
    batches = [
        pa.RecordBatch.from_pydict({"text": pa.array(part, pa.string())})
        for part in (listed, [], [None])
    ]
    pieces = list(in_pieces(iter(batches), "text"))
    found = [value for piece in pieces for value in piece.column("text").to_pylist()]
    assert found == [*listed, None]
    for piece in pieces:
        lengths = [len(value or "") for value in piece.column("text").to_pylist()]
        assert piece.num_rows and sum(lengths[1:]) <= PIECE_BYTES
