"""The registered queries of the operators, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sift.llm import (
    bpe,
    chat,
    embedding_dedup,
    exact_dedup,
    language,
    markov_lm,
    merkle,
    mixing,
    near_dedup,
    passages,
    quality,
    sharding,
    vector_codes,
)
from sift.llm.common import read_table, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BLANKS = r"[^\x20\x09-\x0D]+"
LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


@query(
    f"""
    with bodies as (select doc_id, {LOWERED} as body from documents)
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
           doc_id = max(doc_id) over same as kept, sha256(body) as text_sha256
    from bodies window same as (partition by body)
    """
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"), keep="largest")


@query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coder = bpe.ByteBpe.from_file(
        spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return coder.encode(docs, bytes_col="decoded").select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        bpe.digest_of_ids("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op6_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(read_table(spark, sf_dir, "documents"), 16)
    return placed.withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


def conversation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations and number -7 as the log of a chat that was streamed.

    Every turn comes as a message with the first half of its text and a delta
    with the rest. Each third turn is a draft first, which an edit replaces,
    and after each fourth one a next turn is begun that a regeneration takes
    back. What the log folds to are the conversations.
    """
    probe = "</s>[INST] ok [/INST]"
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"))
    role = F.when(F.col("turn") == 0, "user").otherwise("assistant")
    rows = rows.unionByName(added.withColumns({"role": role, "text": F.lit(probe)}))
    # rows of the same turn stay messages of their own
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("number", F.row_number().over(order).cast("bigint"))
    half = (F.length("text") / 2).cast("int")
    begin, rest = F.substr("text", F.lit(1), half), F.substr("text", half + 1)
    third, fourth = (F.col("number") % n == 0 for n in (3, 4))

    def event(at: int, kind: str, text: Column, *, later: int = 0, if_: Column | None = None) -> Column:
        made = F.struct(
            (F.col("number") * 10 + at).alias("seq"),
            F.lit(kind).alias("event"),
            (F.col("number") + later).alias("turn"),
            F.when(F.lit(kind != "delta"), F.col("role")).alias("role"),
            text.alias("text"),
        )
        return made if if_ is None else F.when(if_, made)

    events = F.array(
        event(0, "message", F.when(third, F.concat(F.lit("draft "), begin)).otherwise(begin)),
        event(1, "delta", rest),
        event(2, "edit", begin, if_=third),
        event(3, "delta", rest, if_=third),
        event(4, "message", F.lit("to be taken back"), later=1, if_=fourth),
        event(5, "regenerate", begin, if_=fourth),
        event(6, "delta", rest, if_=fourth),
    )
    return rows.select("conv_id", F.inline(F.array_compact(events)))


@query(
    """
    with rows as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
        from conversations
        union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                         (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
    ), parts as (
        select conv_id, turn, role, text, role || chr(10) || text || chr(10) as turn_text,
               case when role = 'assistant' then text else '' end as learnt,
               length(role) + length(text) + 18
               + length(regexp_replace(role || text, '[^~<[]', '', 'g'))
               + length(regexp_replace(role, '[^' || chr(10) || ']', '', 'g')) as chars
        from rows
    )
    select conv_id, count(*) as n_turns,
           sha256(string_agg(turn_text, '' order by turn, role, text)) as turns_sha256,
           sum(length(learnt))::bigint as loss_chars,
           sha256(string_agg(learnt, '' order by turn, role, text)) as loss_sha256,
           sum(chars)::bigint as formatted_chars
    from parts group by conv_id
    """
)
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chat.format_log(conversation_events(spark, sf_dir))
    turns = chat.parse(F.col("formatted"))
    lines = F.transform(
        turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    learnt = chat.masked(F.col("formatted"), F.col("loss_spans"))
    return made.withColumns({"learnt": learnt}).select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query(
    f"""
    with sized as (
        select doc_id, source,
               len(regexp_extract_all(coalesce(text, ''), '{BLANKS}'))::bigint as size,
               ('0x' || md5('mix:' || coalesce(doc_id::varchar, ''))[1:8])::bigint % 4096 as bin
        from documents
    ), totals as (
        select source, sum(size)::bigint as source_size from sized group by source
    ), weighted as (
        select *, [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight,
               sum(source_size) over () as all_words
        from totals
    ), levels as (
        select *, 4 * source_size * sum(weight) over onward
                  <= (3 * all_words - 4 * coalesce(sum(source_size) over before, 0)) * weight
                  as stopped
        from weighted
        window onward as (order by source_size / weight, source nulls last
                          rows between current row and unbounded following),
               before as (order by source_size / weight, source nulls last
                          rows between unbounded preceding and 1 preceding)
    ), shared as (
        select source, source_size,
               case when stopped then (2 * source_size)::double
                    else ((3 * all_words - 4 * sum(case when stopped then source_size else 0 end)
                           over ()) * weight)::double
                         / (2 * sum(case when stopped then 0 else weight end) over ())
               end as target
        from levels
    ), plan as (
        select *, case when source_size = 0 then 0 else floor(target / source_size) end::int
                  as copies
        from shared
    ), bins as (
        select source, bin, sum(size) as words from sized group by source, bin
    ), reached as (
        select source, bin,
               sum(words) over (partition by source order by bin) - words / 2 as reached
        from bins
    ), cuts as (
        select p.source, max(bin) as last_bin
        from reached r join plan p on p.source is not distinct from r.source
        where reached <= target - copies * source_size group by p.source
    )
    select doc_id, size, source_size, target,
           size * (copies + case when copies < 2 and coalesce(bin <= last_bin, false)
                            then 1 else 0 end) as taken
    from sized s
    join plan p on p.source is not distinct from s.source
    left join cuts c on c.source is not distinct from s.source
    """
)
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("copies")


@query()
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4
    return language.identify(read_table(spark, sf_dir, "documents"), share != 2)


@query(
    f"""
    with recursive split as (
        select doc_id, regexp_extract_all({LOWERED}, '{BLANKS}') as w from documents
    ), sets as (
        select doc_id, list_distinct(case when len(w) = 0 then []::varchar[]
                   when len(w) < 4 then [array_to_string(w, ' ')]
                   else list_transform(range(1, len(w) - 2),
                                       lambda i: array_to_string(w[i:i + 3], ' ')) end) as shingles
        from split
    ), shingles as (
        select doc_id, len(shingles) as n, unnest(shingles) as shingle from sets
    ), links as (
        select a.doc_id as a, b.doc_id as b
        from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id
        group by a.doc_id, b.doc_id, a.n, b.n
        having 100 * count(*) >= 80 * (a.n + b.n - count(*))
    ), edges as (
        select a, b from links union all select b, a from links
    ), reached as (
        select a as doc_id, a as other from edges
        union
        select r.doc_id, e.b from reached r join edges e on e.a = r.other
    ), components as (
        select doc_id, min(other) as component_id from reached group by doc_id
    )
    select doc_id, len(shingles)::bigint as n_shingles,
           coalesce(component_id, doc_id) as component_id,
           coalesce(component_id, doc_id) = doc_id as kept
    from sets left join components using (doc_id)
    """
)
def op5_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(read_table(spark, sf_dir, "documents"), k=4)


@query(
    """
    with recursive usable as (
        select vec_id, embedding::double[] as v from embeddings
        where embedding is not null
          and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
          and len(list_filter(embedding, lambda c: c <> 0)) > 0
    ), units as (
        select vec_id, list_transform(v, lambda c: c / sqrt(list_sum(list_transform(v, lambda d: d * d)))) as u
        from usable
    ), links as (
        select a.vec_id as a, b.vec_id as b from units a join units b
          on a.vec_id <> b.vec_id and len(a.u) = len(b.u) and list_inner_product(a.u, b.u) >= 0.9
    ), reached as (
        select a as vec_id, a as other from links
        union
        select r.vec_id, l.b from reached r join links l on l.a = r.other
    ), counts as (
        select a as vec_id, count(*) as n_links from links group by a
    ), components as (
        select vec_id, min(other) as component_id from reached group by vec_id
    )
    select vec_id, coalesce(n_links, 0) as n_links, coalesce(component_id, vec_id) as component_id,
           coalesce(component_id, vec_id) = vec_id as kept
    from embeddings left join counts using (vec_id) left join components using (vec_id)
    """
)
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


@query()
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.assess(docs, read_table(spark, sf_dir, "labels"))
    return found.drop("text").withColumnRenamed("accepted", "kept")


@query()
def op2_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(read_table(spark, sf_dir, "documents"))


# CRC-32 of an id's decimal digits, bit by bit.
CRC_OF_ID = """
    xor(4294967295, list_reduce(
        list_prepend(4294967295::bigint,
                     list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
            lambda x, _: xor(x >> 1, 3988292384::bigint * (x & 1)))))
"""


@query(
    f"""
    with recursive given as (
        select row_number() over () as r, doc_id, source, lang, n_chars, text,
               case when {CRC_OF_ID} % 2 = 0 then replace(text, chr(10), '') else text end as now
        from documents
    ), spelled as (
        select r, doc_id, source, text, now,
               list_aggregate(list_transform([doc_id::varchar, source, lang, n_chars::varchar],
                   lambda v: coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '') as head
        from given
    ), leaves as (
        select r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
               sha256(head || coalesce(strlen(now) || ':' || now, '-')) as tampered
        from spelled
    ), placed as (
        select *, row_number() over (partition by source order by doc_id nulls first, leaf, r) - 1 as pos
        from leaves
    ), nodes as (
        select 0 as level, source, pos, leaf as h, count(*) over (partition by source) as n
        from placed
        union all
        select level + 1, source, pos // 3, sha256(string_agg(h, '' order by pos)), (n + 2) // 3
        from nodes where n > 1 group by level, source, pos // 3, n
    ), subroots as (
        select source, h as subroot, row_number() over (order by source nulls first) - 1 as place
        from nodes where n = 1
    ), tops as (
        select 0 as level, place, subroot as h, count(*) over () as n from subroots
        union all
        select level + 1, place // 3, sha256(string_agg(h, '' order by place)), (n + 2) // 3
        from tops where n > 1 group by level, place // 3, n
    ), paths as (
        select p.r, x.level, x.pos as x_pos, p.pos // (3 ** x.level)::bigint as mine, x.h
        from placed p join nodes x
          on x.source is not distinct from p.source and x.n > 1
         and x.pos // 3 = p.pos // (3 ** (x.level + 1))::bigint
        union all
        select p.r, 1000 + x.level, x.place, s.place // (3 ** x.level)::bigint, x.h
        from placed p join subroots s on s.source is not distinct from p.source
        join tops x on x.n > 1 and x.place // 3 = s.place // (3 ** (x.level + 1))::bigint
    ), steps as (
        select r, level, coalesce(string_agg(h, '' order by x_pos) filter (x_pos < mine), '') as before,
               coalesce(string_agg(h, '' order by x_pos) filter (x_pos > mine), '') as after,
               row_number() over (partition by r order by level) as step
        from paths group by r, level
    ), folded as (
        select r, 0 as step, tampered as h from placed
        union all
        select f.r, f.step + 1, sha256(s.before || f.h || s.after)
        from folded f join steps s on s.r = f.r and s.step = f.step + 1
    ), proofs as (
        select r, sha256(string_agg(before || after, '' order by step)) as proof_sha256, max(step) as last
        from steps group by r
    )
    select p.doc_id, p.leaf, s.subroot, t.h as root,
           coalesce(q.proof_sha256, sha256('')) as proof_sha256, f.h as folded_root,
           f.h = t.h as verified
    from placed p
    join subroots s on s.source is not distinct from p.source
    join (select h from tops where n = 1) t on true
    left join proofs q on q.r = p.r
    join folded f on f.r = p.r and f.step = coalesce(q.last, 0)
    """
)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    # rows whose id has an even checksum lose their line breaks after hashing
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.col("text").contains("\n")
    cut = merkle.leaf_digest(*map(F.col, fields[:-1]), F.replace("text", F.lit("\n"), F.lit("")))
    made = merkle.merkle_manifest(docs, fields=fields, keep={"tampered": F.when(hit, cut)})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return made.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def code_sql(rounds: int = 4) -> str:
    """The rounds of op11 one after the other, every part against every entry."""
    assign = """
    distances{n} as (
        select v.vec_id, v.part, e.entry, sum((v.x - e.x) * (v.x - e.x))::bigint as d
        from x v join books{n} e on e.part = v.part and e.pos = v.pos
        group by v.vec_id, v.part, e.entry
    ), near{n} as (
        select vec_id, part, min(d) as d, arg_min(entry, (d, entry)) as entry
        from distances{n} group by vec_id, part
    )"""
    move = """
    books{m} as (
        select b.part, b.entry, b.pos, coalesce(s.x, b.x) as x
        from books{n} b left join (
            select a.part, a.entry, v.pos, floor(sum(v.x)::bigint / count(*))::bigint as x
            from near{n} a join x v on v.vec_id = a.vec_id and v.part = a.part
            group by a.part, a.entry, v.pos
        ) s on s.part = b.part and s.entry = b.entry and s.pos = b.pos
    )"""
    steps = [(assign + "," + move).format(n=n, m=n + 1) for n in range(rounds)]
    return f"""
    with good as (
        select vec_id, label, embedding from embeddings
        where embedding is not null
          and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
    ), x as materialized (
        select vec_id, (i - 1) // (len(embedding) // 4) as part, (i - 1) % (len(embedding) // 4) as pos,
               floor(1024 * embedding[i]::double)::bigint as x
        from (select *, unnest(range(1, len(embedding) + 1)) as i from good)
    ), books0 as (
        select x.part, f.entry, x.pos, x.x
        from x join (select vec_id, row_number() over (order by vec_id) - 1 as entry from good
                     order by vec_id limit 256) f using (vec_id)
    ), {", ".join(steps)}, {assign.format(n=rounds)}, codes as (
        select vec_id, sum(d)::bigint as error,
               string_agg(lower(printf('%02x', entry)), '' order by part) as code
        from near{rounds} group by vec_id
    ), digest as (
        select sha256(string_agg(x::varchar, ',' order by part, entry, pos)) as codebooks_sha256
        from books{rounds}
    )
    select c.vec_id, code, error, sum(error) over (partition by g.label)::bigint as label_error,
           codebooks_sha256
    from codes c join good g using (vec_id) cross join digest
    """


@query(code_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    coded, books = vector_codes.encode_vectors(vectors, keep=[F.col("label")])
    coded = stage(coded, "codes")
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = stage(totals.withColumnRenamed("label", "of"), "label-errors")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )


@query()
def op13_markov_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7
    return markov_lm.score_documents(read_table(spark, sf_dir, "documents"), share != 2)
