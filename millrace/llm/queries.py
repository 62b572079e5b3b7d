"""The registered queries of this package, and the SQL that checks them where SQL can say it."""

from __future__ import annotations

from millrace.llm import (chaining, collisions, ctw, langid, licence_texts, licences, mixing, packing, pivots, pq, sharding,
                          simhash, sql, suffixes, zones)
from millrace.session import load

#: Named in the packing query's contract; a parameter of the operator.
TOKENIZER = "byte_bpe_50k.json"

QUERIES = {}
CHECKS = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            CHECKS[fn.__name__] = sql
        return fn
    return add


@query()
def op1_simhash(spark, sf_dir):
    return simhash.simhash_groups(load(spark, sf_dir, "documents"), width=3)


@query()
def op2_packing(spark, sf_dir):
    import public_tokenizers

    return packing.pack(load(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), size=1024, added=True)


@query()
def op3_embedding_dedup(spark, sf_dir):
    return pq.near_duplicates(load(spark, sf_dir, "embeddings"), cosine=0.9)


@query()
def op4_suffix_dedup(spark, sf_dir):
    return suffixes.remove_repeats(load(spark, sf_dir, "documents"), length=200, scan=True).drop("kept_text")


@query(sql.mix([5, 2, 1], epochs=3))
def op5_mixing(spark, sf_dir):
    return mixing.mix(load(spark, sf_dir, "documents"), weights=[5, 2, 1], epochs=3).drop("repeats")


@query()
def op6_nearest(spark, sf_dir):
    return collisions.nearest(load(spark, sf_dir, "embeddings"), every=100, k=10)


@query()
def op7_sharding(spark, sf_dir):
    return sharding.shard(load(spark, sf_dir, "documents"), shards=8)


@query()
def op8_chaining(spark, sf_dir):
    return chaining.passages(load(spark, sf_dir, "documents"), scan=True)


@query()
def op9_langid(spark, sf_dir):
    return langid.identify(load(spark, sf_dir, "documents"))


@query()
def op10_ctw(spark, sf_dir):
    return ctw.score(load(spark, sf_dir, "documents"))


@query(sql.codes())
def op11_pivots(spark, sf_dir):
    return pivots.compress(load(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)


@query(sql.licence_scan(licence_texts.TEMPLATES, licence_texts.PHRASES))
def op12_licences(spark, sf_dir):
    return licences.scan(load(spark, sf_dir, "documents"), licence_texts.TEMPLATES, licence_texts.PHRASES).drop("places")


@query(sql.clusters())
def op13_zones(spark, sf_dir):
    return zones.cluster(load(spark, sf_dir, "embeddings"), dim=64, scale=64, k=16, rounds=3)
