import random
import re

import corpus_pipeline
from agroflow.llm import decontamination, packing, simhash

WORDS = [f"{a}{b}" for a in ("ri", "sto", "gar", "wea", "peo", "tal", "gre", "mo", "fe", "lun") for b in ("ver", "nes", "dens", "ther", "ple", "king", "en", "on", "ld", "ch")]


def corpus(spark, folder):
    rng = random.Random(1)
    sentence = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    docs, labels, kinds = [], [], {}
    items = [(i, sentence(30)) for i in range(4)]
    for i in range(400):
        kind = rng.choice(["plain", "plain", "toxic", "toxic", "copy", "near", "leak", "secret"])
        text = sentence(rng.choice([60, 120, 300]))
        if kind == "toxic":
            text += " " + rng.choice(["idiot", "IDIOT!", "id1ot"])
        if kind in ("copy", "near"):
            plain = [d for d in docs if kinds[d[0]] == "plain"]
            if plain:
                text = rng.choice(plain)[1]
                words = text.split()
                if kind == "near":
                    words[len(words) // 2] = "zz"
                text = " ".join(words)
            else:
                kind = "plain"
        if kind == "leak":
            words = text.split()
            words[20:20] = rng.choice(items)[1].split()
            text = " ".join(words)
        if kind == "secret":
            text += ' token = "0123456789abcdef0123456789abcdef"'
        kinds[i] = kind
        docs.append((i, text, "en", "src1", len(text)))
        labels.append((i, 1, int(kind == "toxic")))
    docs += [(900, None, None, None, None), (901, "", "en", "s", 0), (902, "", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {d[0]: d for d in docs}, kinds


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    docs, kinds = corpus(spark, folder)
    numbers = [4, 9, 8, 5, 2]
    assert len(corpus_pipeline.STAGES) == len(numbers) and corpus_pipeline.ORACLE_SQL is None
    table = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [table]
    for name, apply in corpus_pipeline.STAGES[:-1]:
        apply(spark, kept[-1], folder).write.parquet(f"{folder}/out-{name}")
        kept.append(spark.read.parquet(f"{folder}/out-{name}"))
        assert kept[-1].columns == table.columns
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in kept]
    # Toxic documents go, and only these.
    assert ids[0] - ids[1] == {i for i, k in kinds.items() if k == "toxic"}
    # Copies go, and of near ones those within two bits; the rows without text are copies, too.
    copies = {i for i, k in kinds.items() if k == "copy"} | {901, 902}
    near = {i for i, k in kinds.items() if k == "near"}
    classes = {r.doc_id: r.component_id for r in simhash.near_duplicates(kept[1]).collect()}
    assert ids[1] - ids[2] == {i for i, first in classes.items() if first != i}
    assert copies <= ids[1] - ids[2] <= copies | near
    assert ids[2] - ids[3] == {i for i, k in kinds.items() if k == "leak"}
    assert ids[3] == ids[4]
    for r in kept[4].collect():
        before = docs[r.doc_id][1]
        wanted = before if kinds.get(r.doc_id) != "secret" else re.sub(r'token = "[0-9a-f]+', "[REDACTED]", before)
        assert r.text == wanted and (r.text is None or r.n_chars == len(r.text))
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} == ids[4]
    encode = packing.encoder(packing.public_tokenizers.path(packing.TOKENIZER), None).encode
    tokens = {r.doc_id: len(encode(r.text or "")) // 4 + 1 for r in kept[4].collect()}
    assert sum(r.length for r in packed) == sum(tokens.values())
    gaps = []
    for n in sorted((r.length for r in packed), reverse=True):
        fits = [g for g in gaps if g >= n]
        gaps.append(min(fits, default=1024) - n)
        if fits:
            gaps.remove(min(fits))
    assert len({r.sequence_id for r in packed}) <= len(gaps)
    assert decontamination.contaminated(kept[4], spark.read.parquet(f"{folder}/benchmark.parquet")).count() == 0
