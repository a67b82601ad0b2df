"""ANSI SQL that gives the same rows as the registered queries, for checking them in DuckDB."""

from __future__ import annotations

from sparkprep.schema import COMPLAINTS
from sparkprep.sources.tables import VIEW_COLUMNS

COMPLAINTS_VIEW = """complaints as (
select o.o_orderkey complaint_id, o.o_orderdate date_received, f.first_ship date_sent_to_company,
  nullif(o.o_orderpriority, '4-NOT SPECIFIED') company_response,
  case when o.o_orderkey % 10 < 6 then null
       else nullif(c.c_mktsegment, 'HOUSEHOLD') end company_public_response,
  nullif(c.c_mktsegment, 'MACHINERY') consumer_consent_provided,
  case when o.o_orderkey % 7 = 0 then null else o.o_orderstatus end submitted_via,
  p.p_name issue,
  case o.o_orderstatus when 'F' then 'Yes' when 'O' then 'No' end consumer_disputed
from orders o
left join customer c on o.o_custkey = c.c_custkey
left join (select l_orderkey, min(l_shipdate) first_ship, min(l_partkey) first_part
           from lineitem group by l_orderkey) f on f.l_orderkey = o.o_orderkey
left join part p on p.p_partkey = f.first_part)"""

ONE_HOT = COMPLAINTS.one_hot

# Whitespace as Java's \s has it; RE2's \s lacks the vertical tab.
SPACE = r"[ \t\n\v\f\r]"
TRIMMED = "rtrim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
TERMS = f"""terms as (
select doc_id, term, count(*) tf
from (select doc_id, unnest(regexp_split_to_array({TRIMMED}, '{SPACE}')) term from documents) w
where term <> '' group by doc_id, term)"""

DIFFERENCES = """diffs as (
select complaint_id,
  abs(epoch(date_received) - epoch(date_sent_to_company)) / cast(86400 as double) diff_in_days
from complaints)"""

IN_TRAIN = "('0x' || substr(md5(cast(complaint_id as varchar)), 1, 8))::ubigint % 1000 < 700"


def on_complaints(body: str, *views: str) -> str:
    return "with " + ",\n".join((COMPLAINTS_VIEW, *views)) + "\n" + body


def per_column(template: str, columns=ONE_HOT) -> str:
    return " union all ".join(template.format(c=c) for c in columns)


def category_counts(source: str, columns=ONE_HOT) -> str:
    return per_column(
        f"select '{{c}}' \"column\", cast({{c}} as varchar) category, count(*) n "
        f"from {source} group by {{c}}",
        columns,
    )


def most_frequent(columns) -> str:
    return on_complaints(
        f"""select "column", category, n from (
            select *, row_number() over (partition by "column" order by n desc, category) r
            from ({category_counts('complaints', columns)}) where category is not null)
            where r = 1"""
    )


MODE_VIEWS = tuple(
    f"""mode_{c} as (select {c} v from complaints where {c} is not null
        group by {c} order by count(*) desc, {c} limit 1)"""
    for c in ONE_HOT
)
IMPUTED = ", ".join(f"coalesce({c}, (select v from mode_{c})) im_{c}" for c in ONE_HOT)


def index_view(name: str, source: str, column: str) -> str:
    return f"""{name} as (select v, row_number() over (order by n desc, v) - 1 position
        from (select {column} v, count(*) n from {source}
              where {column} is not null group by {column}))"""


INDEX_VIEWS = tuple(index_view(f"index_{c}", "complaints", c) for c in ONE_HOT)


def feature_table() -> str:
    return on_complaints(
        f"""select complaint_id, round(im_diff_in_days, 6) im_diff_in_days,
            {", ".join(f"im_{c}" for c in ONE_HOT)},
            {", ".join(f"s_{c}.position si_{c}" for c in ONE_HOT)}
        from filled {" ".join(f"join s_{c} on s_{c}.v = im_{c}" for c in ONE_HOT)}""",
        DIFFERENCES,
        *MODE_VIEWS,
        f"""filled as (select complaint_id,
            coalesce(diff_in_days, (select avg(diff_in_days) from diffs)) im_diff_in_days, {IMPUTED}
        from complaints join diffs using (complaint_id))""",
        *(index_view(f"s_{c}", "filled", f"im_{c}") for c in ONE_HOT),
    )


def frequency_encoded(join: str) -> str:
    on = "is not distinct from" if join == "left" else "="
    return on_complaints(
        f"""select complaint_id, {", ".join(f"coalesce(f_{c}.n, 0) freq_{c}" for c in ONE_HOT)}
        from complaints t {" ".join(f"{join} join f_{c} on f_{c}.v {on} t.{c}" for c in ONE_HOT)}""",
        *(
            f"f_{c} as (select {c} v, count(*) n from complaints where {IN_TRAIN} group by {c})"
            for c in ONE_HOT
        ),
    )


def windows(source: str, ts: str) -> str:
    return f"""with bounds as (
    select cast(min({ts}) as date) f, cast(max({ts}) as date) + 1 t from {source}),
sized as (
    select f, t, case when t - f > 365 then 'year' when t - f > 30 then 'month'
                      when t - f > 7 then 'week' else 'single' end u from bounds),
starts as (
    select f, t, u, cast(unnest(case u
        when 'year' then range(cast(date_trunc('year', f) as timestamp), cast(t as timestamp), interval 1 year)
        when 'month' then range(cast(date_trunc('month', f) as timestamp), cast(t as timestamp), interval 1 month)
        when 'week' then range(cast(date_trunc('week', f) as timestamp), cast(t as timestamp), interval 7 day)
        else [cast(f as timestamp)] end) as date) s from sized),
windows as (
    select u granularity, greatest(s, f) from_date,
           coalesce(lead(s) over (order by s), t) to_date from starts)
"""


def window_counts(source: str, ts: str) -> str:
    return windows(source, ts) + f"""
select cast(from_date as varchar) from_date, cast(to_date as varchar) to_date, count({ts}) n
from windows left join {source} on {ts} >= from_date and {ts} < to_date
group by from_date, to_date"""


def profile_row(extra: str) -> str:
    return per_column(
        f"""select '{{c}}' "column", {extra}
        count(*) - count({{c}}) missing_row,
        round((count(*) - count({{c}})) * 100.0::double / count(*), 6) missing_percentage
        from complaints""",
        VIEW_COLUMNS,
    )


# The constants of the public 32-bit MurmurHash3, and the seed and width hashing uses.
MASK = 4294967295
C1, C2, C5 = 3432918353, 461845907, 3864292196
F1, F2 = 2246822507, 3266489909
SEED = 42
HASHED_WIDTH = 40


def hashed_words(source: str) -> str:
    """Views that give each distinct ``term`` of ``source`` its hash ``bucket``."""
    return f"""word_bytes as (
    select term, octet_length(encode(term)) len,
           list_transform(range(0, octet_length(encode(term))), lambda i:
               cast('0x' || substr(hex(encode(term)), cast(2 * i + 1 as bigint), 2) as ubigint)) b
    from (select distinct term from {source})),
word_blocks as (
    select term, len, len // 4 blocks,
           list_transform(range(0, cast(ceil(len / 4.0) as bigint)), lambda i: list_sum(list_transform(
               range(4 * i, least(4 * i + 4, len)), lambda j: b[j + 1] << cast(8 * (j - 4 * i) as ubigint))))
               k0
    from word_bytes),
word_k1 as (
    select term, len, blocks, list_transform(k0, lambda k: (cast(k as ubigint) * {C1}::ubigint) & {MASK}::ubigint) k
    from word_blocks),
word_k2 as (
    select term, len, blocks,
           list_transform(k, lambda x: ((((x << 15) | (x >> 17)) & {MASK}::ubigint) * {C2}::ubigint) & {MASK}::ubigint) k
    from word_k1),
word_body as (
    select term, len, k, blocks, list_reduce(k[1:blocks], lambda h, x:
        (((((xor(h, x) << 13) | (xor(h, x) >> 19)) & {MASK}::ubigint) * 5::ubigint) + {C5}::ubigint) & {MASK}::ubigint,
        {SEED}::ubigint) h
    from word_k2),
word_h1 as (
    select term, xor(xor(h, coalesce(k[blocks + 1], 0::ubigint)), cast(len as ubigint)) h from word_body),
word_h2 as (select term, (xor(h, h >> 16) * {F1}::ubigint) & {MASK}::ubigint h from word_h1),
word_h3 as (select term, (xor(h, h >> 13) * {F2}::ubigint) & {MASK}::ubigint h from word_h2),
word_h4 as (select term, cast(xor(h, h >> 16) as bigint) h from word_h3),
hashed as (
    select term, cast(((case when h > 2147483647 then h - 4294967296 else h end) % {HASHED_WIDTH}
        + {HASHED_WIDTH}) % {HASHED_WIDTH} as integer) bucket from word_h4)"""


DOCUMENT_WORDS = f"""words as (
select doc_id, unnest(regexp_split_to_array({TRIMMED}, '{SPACE}')) term from documents)"""
DOCUMENT_BUCKETS = f"""{DOCUMENT_WORDS},
{hashed_words('words')},
tfs as (select doc_id, bucket, cast(count(*) as double) tf from words join hashed using (term)
        group by doc_id, bucket)"""


def features(body: str) -> str:
    """``entries(complaint_id, position, value)``: the non-zero entries of the assembled vectors.

    Everything is fitted on the training side and applied to all rows.
    """
    trained = "(select * from diffed where train)"
    indexes = [index_view(f"s_{c}", "(select * from filled where train)", f"im_{c}") for c in ONE_HOT]
    modes = [
        f"""mode_{c} as (select {c} v from {trained} where {c} is not null
        group by {c} order by count(*) desc, {c} limit 1)"""
        for c in ONE_HOT
    ]
    widths = [f"(select count(*) from s_{c})" for c in ONE_HOT]
    offsets = ["0", widths[0], f"{widths[0]} + {widths[1]}", " + ".join(widths)]
    one_hots = " union all ".join(
        f"""select complaint_id, train, s_{c}.position + {offset} as "position", 1.0::double value
        from filled join s_{c} on s_{c}.v = im_{c}"""
        for c, offset in zip(ONE_HOT, offsets)
    )
    return on_complaints(
        body,
        f"""diffed as (select *, {IN_TRAIN} train,
            abs(epoch(date_received) - epoch(date_sent_to_company)) / cast(86400 as double) diff
            from complaints)""",
        *modes,
        f"""filled as (select complaint_id, train, issue, {IMPUTED},
            coalesce(diff, (select avg(diff) from {trained})) im_diff from diffed)""",
        *indexes,
        f"""words as (select complaint_id, train, unnest(regexp_split_to_array(
            {TRIMMED.replace("text", "coalesce(issue, '')")}, '{SPACE}')) term from filled)""",
        hashed_words("words"),
        """tfs as (select complaint_id, train, bucket, cast(count(*) as double) tf
            from words join hashed using (term) group by complaint_id, train, bucket)""",
        """idfs as (select bucket, ln(((select count(*) from filled where train) + 1)
            / cast(sum(case when train then 1 else 0 end) + 1 as double)) idf from tfs group by bucket)""",
        f"""entries as ({one_hots}
            union all select complaint_id, train, {offsets[3]}, im_diff from filled where im_diff <> 0
            union all select complaint_id, train, {offsets[3]} + 1 + bucket, tf * idf
            from tfs join idfs using (bucket) where tf * idf <> 0)""",
        "trained as (select count(*) n from filled where train)",
        """moments as (select "position", sum(value) s, sum(value * value) ss,
            (select n from trained) n from entries where train group by "position")""",
        """deviations as (select "position", sqrt(greatest(0, (ss - s * s / n) / (n - 1))) deviation
            from moments)""",
    )


MATRIX = """matrix as (select cast(quality as double) label, cast(toxic as double) prediction,
    count(*) n from labels group by 1, 2)"""
RATED = f"""with {MATRIX},
counts as (
    select class, cast(sum(actual) as bigint) actual, cast(sum(predicted) as bigint) predicted,
           cast(sum(tp) as bigint) tp
    from (select label class, n actual, 0 predicted, case when label = prediction then n else 0 end tp
          from matrix
          union all select prediction, 0, n, 0 from matrix) x group by class),
rated as (
    select *, coalesce(tp / nullif(cast(predicted as double), 0), 0) as "precision",
           coalesce(tp / nullif(cast(actual as double), 0), 0) recall,
           coalesce((predicted - tp) / nullif(cast((select sum(n) from matrix) - actual as double), 0), 0)
               false_positive_rate
    from counts),
scored as (
    select *, coalesce(2 * "precision" * recall / nullif("precision" + recall, 0), 0) f_measure from rated)
"""


def scores() -> str:
    def weighted(name: str) -> str:
        return f"sum(actual * {name}) / cast(sum(actual) as double)"

    accuracy = "cast(sum(tp) as double) / cast(sum(actual) as double)"
    metrics = {
        "accuracy": accuracy,
        "weightedPrecision": weighted('"precision"'),
        "weightedRecall": weighted("recall"),
        "weightedTruePositiveRate": weighted("recall"),
        "weightedFalsePositiveRate": weighted("false_positive_rate"),
        "f1": weighted("f_measure"),
        "hammingLoss": f"1 - {accuracy}",
    }
    return RATED + " union all ".join(
        f"select '{name}' metric, round({value}, 6) score from scored" for name, value in metrics.items()
    )


REJECTED = (
    "complaint_id: unwanted column; company_public_response: contains many missing values"
)
RUN_REJECTED = "; ".join(
    [f"{c}: contains many missing values" for c in COMPLAINTS.carried]
    + ["sub_product: unwanted column", "complaint_what_happened: unwanted column"]
    + ["company_public_response: contains many missing values"]
)
LANDED_EVENTS = "select event_id, user_id, event_type from events where event_type not in ('error', 'click')"

ORACLE: dict[str, str] = {
    "src_parquet_scan": on_complaints("select * from complaints"),
    "src_json_landing": on_complaints(
        """select complaint_id, company_response, issue,
        strftime(date_received, '%Y-%m-%d') date_received from complaints"""
    ),
    "src_envelope_unwrap": """select event_id, cast(json_extract_string(props, '$.k') as bigint) k
        from events where event_type <> 'error'""",
    "src_quarantine_count": """select case event_type when 'error' then 'corrupt'
        when 'click' then 'no payload' else 'parsed' end outcome, count(*) n from events group by 1""",
    "src_feature_store": on_complaints(
        """select complaint_id, company_response,
        strftime(date_received, '%Y-%m') received_month from complaints"""
    ),
    "inc_watermark_max": windows("orders", "o_orderdate")
    + "select cast(max(to_date) as varchar) watermark from windows",
    "inc_granularity": windows("orders", "o_orderdate")
    + "select cast(f as varchar) from_date, cast(t as varchar) to_date, u granularity from sized",
    "inc_windows": windows("orders", "o_orderdate")
    + """select granularity, cast(from_date as varchar) from_date, cast(to_date as varchar) to_date
        from windows""",
    "inc_window_counts": window_counts("orders", "o_orderdate"),
    "inc_window_counts_sent": window_counts("sent", "date_sent_to_company").replace(
        "with bounds",
        "with " + COMPLAINTS_VIEW + ",\nsent as (select date_sent_to_company from complaints),\nbounds",
        1,
    ),
    "inc_resume": on_complaints(
        """select case when complaint_id % 20 = 0 then 'unkeyed' when complaint_id % 30 = 1 then 'undated'
            when date_received < date '1993-01-01' then 'early' else 'store' end place, complaint_id
        from complaints"""
    ),
    "inc_watermark_table": """with last as (select cast(max(o_orderdate) as date) d from orders),
        loads as (select date '1990-01-01' f, date '1995-01-01' t
            union all select date '1995-01-01', d from last union all select date '1994-01-01', d from last)
        select cast(f as varchar) from_date, cast(t as varchar) to_date,
            (select cast(max(t) as varchar) from loads) next_from from loads""",
    "src_quarantine_rows": """select 'Throttled. Expected available in 42 seconds.' content,
        false partly_parsed, count(*) n from events where event_type = 'error' having count(*) > 0""",
    "stream_store_rows": """select event_id, case when event_id % 10 = 3 then 'undated' else 'store' end place
        from events where event_type <> 'error'""",
    "inc_window_counts_events": window_counts("events", "ts"),
    "src_store_keys": on_complaints("select complaint_id from complaints"),
    "inc_window_extract": """with bounds as (
        select cast(min(o_orderdate) as date) f, cast(max(o_orderdate) as date) + 1 t from orders),
        unit as (select f, case when t - f > 365 then 'year' when t - f > 30 then 'month'
            when t - f > 7 then 'week' else 'single' end u from bounds)
        select o_orderkey, strftime(greatest(f, case u when 'year' then date_trunc('year', o_orderdate)
            when 'month' then date_trunc('month', o_orderdate)
            when 'week' then date_trunc('week', o_orderdate) else f end), '%Y-%m-%d') window_from
        from orders, unit""",
    "inc_merged_counts": on_complaints(category_counts("complaints")),
    "inc_merged_modes": most_frequent(ONE_HOT),
    "inc_merged_moments": """with numbers as (
        select cast(l_extendedprice as double) price, cast(l_quantity as double) + 1e9 far,
            case when l_orderkey % 5 = 0 then cast(l_linenumber as double) end sparse from lineitem)
        """
    + per_column(
        """select '{c}' "column", count({c}) n, round(avg({c}), 4) mean,
        round(stddev_samp({c}), 4) deviation from numbers""",
        ("price", "far", "sparse"),
    ),
    "inc_merged_distinct": on_complaints(
        per_column(
            """select '{c}' "column",
            count(distinct {c}) + max(case when {c} is null then 1 else 0 end) n_unique,
            count(*) - count({c}) missing_row, true as "within" from complaints""",
            [c for c in VIEW_COLUMNS if c != "complaint_id"],
        )
    ),
    "inc_slice": """select o_orderkey, o_orderdate from orders
        where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1998-01-01'""",
    "val_row_cap": on_complaints(
        """select complaint_id, company_response from complaints
        order by md5(cast(complaint_id as varchar)), complaint_id limit 10000"""
    ),
    "val_shape": on_complaints(
        f"select count(*) n_rows, cast({len(VIEW_COLUMNS)} as bigint) n_columns from complaints"
    ),
    "val_missing_report": on_complaints(profile_row("count(*) total_row,")),
    "val_high_missing": on_complaints(
        f"select * from ({profile_row('count(*) total_row,')}) where missing_percentage > 40"
    ),
    "val_reject": on_complaints(
        f"select complaint_id, company_public_response, '{REJECTED}' error_msg from complaints"
    ),
    "val_accepted": on_complaints(
        f"""select {", ".join(c for c in VIEW_COLUMNS
            if c not in ("complaint_id", "company_public_response"))} from complaints"""
    ),
    "val_unique_profile": on_complaints(
        profile_row("count(distinct {c}) + max(case when {c} is null then 1 else 0 end) n_unique,")
    ),
    "val_unique_profile_approx": on_complaints(
        per_column(
            """select '{c}' "column",
            count(distinct {c}) + max(case when {c} is null then 1 else 0 end) n_unique,
            count(*) - count({c}) missing_row, true as "within" from complaints""",
            VIEW_COLUMNS,
        )
    ),
    "val_labelled": on_complaints(
        "select complaint_id, consumer_disputed from complaints where consumer_disputed is not null"
    ),
    "feature_table": feature_table(),
    "feat_cast_ts": on_complaints(
        """select complaint_id, try_cast(case when complaint_id % 11 = 0 then 'not a date'
        else strftime(date_received, '%Y-%m-%d %H:%M:%S') end as timestamp) received from complaints"""
    ),
    "feat_day_diff": on_complaints(
        "select complaint_id, round(diff_in_days, 6) diff_in_days from diffs", DIFFERENCES
    ),
    "feat_mean_impute": on_complaints(
        """select complaint_id,
        round(coalesce(diff_in_days, (select avg(diff_in_days) from diffs)), 6) im_diff_in_days
        from diffs""",
        DIFFERENCES,
    ),
    "feat_scaled_numeric": on_complaints(
        """select complaint_id,
        round(diff_in_days / (select stddev_samp(diff_in_days) from diffs), 6) scaled_diff_in_days
        from diffs""",
        DIFFERENCES,
    ),
    "feat_mode_fit": most_frequent(ONE_HOT),
    "feat_mode_impute": on_complaints(
        f"select complaint_id, {IMPUTED} from complaints", *MODE_VIEWS
    ),
    "feat_freq_fit": on_complaints(category_counts("complaints")),
    "feat_freq_encode": frequency_encoded("left"),
    "feat_freq_encode_large": frequency_encoded("left"),
    "feat_freq_encode_inner": frequency_encoded("inner"),
    "feat_string_index": on_complaints(
        f"""select complaint_id, {", ".join(f"index_{c}.position si_{c}" for c in ONE_HOT)}
        from complaints {" ".join(f"left join index_{c} on index_{c}.v = {c}" for c in ONE_HOT)}""",
        *INDEX_VIEWS,
    ),
    "feat_one_hot": on_complaints(
        per_column(
            """select complaint_id, '{c}' "column", position
            from filled join index_{c} on index_{c}.v = im_{c}
            where position < (select max(position) from index_{c})"""
        ),
        *MODE_VIEWS,
        f"filled as (select complaint_id, {IMPUTED} from complaints)",
        *(index_view(f"index_{c}", "filled", f"im_{c}") for c in ONE_HOT),
    ),
    "feat_tokens": f"""select doc_id, count(*) n_tokens, count(*) filter (where term <> '') n_words
        from (select doc_id, unnest(regexp_split_to_array({TRIMMED}, '{SPACE}')) term from documents) w
        group by doc_id""",
    "feat_term_freq": f"with {TERMS} select doc_id, term, tf from terms",
    "feat_tfidf_terms": f"""with {TERMS},
        df as (select term, count(*) n from terms group by term)
        select doc_id, term, round(tf * ln(((select count(*) from documents) + 1)
            / cast(n + 1 as double)), 6) tfidf
        from terms join df using (term)""",
    "feat_hashing_tf": f"with {DOCUMENT_BUCKETS} select doc_id, bucket, tf from tfs",
    "feat_tfidf_hashed": f"""with {DOCUMENT_BUCKETS},
        idfs as (select bucket, ln(((select count(*) from documents) + 1)
            / cast(count(*) + 1 as double)) idf from tfs group by bucket)
        select doc_id, bucket, round(tf * idf, 6) tfidf from tfs join idfs using (bucket)
        where tf * idf <> 0""",
    "feat_assembled": features(
        """select complaint_id, cast("position" as integer) as "position", round(value, 6) value
        from entries"""
    ),
    "feature_vectors": features(
        """select complaint_id, consumer_disputed, cast("position" as integer) as "position",
        round(value / deviation, 6) value
        from entries join deviations using ("position") join complaints using (complaint_id)
        where deviation > 0"""
    ),
    "model_reloaded": features(
        """select complaint_id, consumer_disputed, cast("position" as integer) as "position",
        round(value / deviation, 6) value
        from entries join deviations using ("position") join complaints using (complaint_id)
        where deviation > 0"""
    ),
    "stage_frequency_encoder": frequency_encoded("left"),
    "stage_frequency_imputer": on_complaints(
        f"select complaint_id, {IMPUTED} from complaints", *MODE_VIEWS
    ),
    "run_rejected": on_complaints(
        f"""select complaint_id, company_public_response,
        'complaint_id: unwanted column; {RUN_REJECTED}' error_msg from complaints"""
    ),
    "run_feature_tables": on_complaints(
        f"""select case when {IN_TRAIN} then 'train' else 'test' end side, consumer_disputed,
        count(*) n from complaints group by 1, 2"""
    ),
    "split_train_test": on_complaints(
        f"""select complaint_id, case when {IN_TRAIN} then 'train' else 'test' end side
        from complaints"""
    ),
    "sort_shuffle_rank": on_complaints(
        """select complaint_id, row_number() over (
            order by md5('s' || cast(complaint_id as varchar)), complaint_id) as "position"
        from complaints"""
    ),
    "balance_undersample": on_complaints(
        """select complaint_id, consumer_disputed from (
            select *, row_number() over (partition by consumer_disputed
                order by md5(cast(complaint_id as varchar)), complaint_id) r
            from complaints where consumer_disputed is not null)
        where r <= (select min(n) from (select count(*) n from complaints
                    where consumer_disputed is not null group by consumer_disputed))"""
    ),
    "set_union": on_complaints(
        """select complaint_id, submitted_via, consumer_disputed from complaints
        where consumer_disputed = 'Yes'
        union all select complaint_id, submitted_via, consumer_disputed from complaints
        where consumer_disputed = 'No'"""
    ),
    "agg_label_histogram": on_complaints(
        "select consumer_disputed, count(*) n from complaints group by consumer_disputed"
    ),
    "agg_top_category": most_frequent(("company_response", "issue")),
    "eval_confusion": f"with {MATRIX} select label, prediction, n from matrix",
    "eval_by_label": RATED
    + """select class, actual, predicted, tp, round("precision", 6) as "precision",
        round(recall, 6) recall, round(false_positive_rate, 6) false_positive_rate,
        round(f_measure, 6) f_measure from scored""",
    "eval_scores": scores(),
    "stream_landing_load": LANDED_EVENTS,
    "stream_batch_profile": on_complaints(
        per_column(
            """select '{c}' "column", count(*) total_row, count(*) - count({c}) missing_row
            from complaints""",
            ("complaint_id", "date_received", "company_response", "submitted_via"),
        )
    ),
}
