"""A small folder of tables for the pipeline."""


def folder(spark, path, rnd):
    docs, labels = [], []
    passage = " ".join(f"p{rnd.randrange(300)}" for _ in range(60))
    for i in range(500):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(60, 120))]
        toxic, good = rnd.random() < 0.2, rnd.random() < 0.8
        if toxic:
            for _ in range(5):
                words[rnd.randrange(len(words))] = rnd.choice(["scoundrel", "rascal", "knave"])
        if not good:
            words = [w.upper() + "!!" for w in words]
        text = " ".join(words)
        if i % 25 == 0 and good and not toxic:
            text += " " + passage
        if i % 40 == 7:
            text = docs[-1][1]
        docs.append((i, text, "en", f"s{i % 3}", len(text), "extra"))
        if i % 40 != 7:
            labels.append((i, int(good), int(toxic)))
    docs += [(1000, None, "en", None, None, None), (1001, "", None, "s1", 0, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, "
                                "n_chars long, score string") \
        .repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int") \
        .write.parquet(f"{path}/labels.parquet")
    return str(path)
