"""The same queries as SQL text for an independent engine, over the same tables.

The texts state each result directly (joins before dimensions, ranked windows for dedup) and share
nothing with the DataFrame code but the view definitions and the salt.
"""

from __future__ import annotations

from clinflow.plans.queries import SALT

CLAIMS = """
    select cast(o_orderkey as varchar) as claim_id,
           case when o_orderkey % 25 = 0 then null
                when o_orderkey % 25 = 1 then '  '
                else cast(o_custkey as varchar) end as member_id,
           cast(o_orderkey % 97 as varchar) as provider_id,
           case when o_orderkey % 101 <> 0 then cast(o_orderdate as date) end as service_date,
           case when o_orderkey % 50 = 7 then -10.0::double else o_totalprice end as paid_amount,
           o_totalprice as allowed_amount,
           case when o_orderstatus <> 'P' then ' ' || lower(o_orderstatus) end as icd10_code,
           case when o_orderkey % 5 <> 0 then o_orderpriority end as cpt_code
    from orders"""

PATIENTS = """
    select cast(c_custkey as varchar) as patient_id,
           c_name as first_name,
           c_mktsegment as last_name,
           cast(date '1950-01-01' + c_nationkey * 365 as date) as dob,
           lpad(cast(c_nationkey as varchar), 5, '0') as zip,
           case when c_custkey % 2 = 0 then 'F' else 'M' end as gender
    from customer"""

# Some patients again with the other gender, and some records without an id.
GAPPY_PATIENTS = f"""
    select * from ({PATIENTS})
    union all
    select * replace (case when gender = 'F' then 'M' else 'F' end as gender) from ({PATIENTS})
    where cast(patient_id as bigint) % 30 = 1
    union all
    select * replace (cast(null as varchar) as patient_id) from ({PATIENTS}) where cast(patient_id as bigint) % 40 = 0"""

# What is left of the claims once their text is read: some amounts and dates cannot be.
READ_CLAIMS = f"""
    select * replace (
        case when cast(claim_id as bigint) % 31 <> 5 then paid_amount end as paid_amount,
        case when cast(claim_id as bigint) % 37 <> 3 then service_date end as service_date)
    from ({CLAIMS})"""
_DATE_TEXT = """case when cast(claim_id as bigint) % 37 = 3 then 'on ' || strftime(service_date, '%Y-%m-%d')
                     else strftime(service_date, '%Y-%m-%d') end"""
READ_WITH_TEXT = f"""
    select r.*, t.service_date_text
    from ({READ_CLAIMS}) r join (select claim_id as id, {_DATE_TEXT} as service_date_text from ({CLAIMS})) t
    on r.claim_id = t.id"""

ENCOUNTERS = """
    select cast(event_id as varchar) as encounter_id,
           cast(user_id as varchar) as patient_id,
           cast(event_id % 97 as varchar) as provider_id,
           cast(ts as date) as encounter_date,
           event_type as diagnosis_code,
           case when event_id % 4 <> 0 then props end as procedure_code
    from events"""

GAPPY = f"""
    select * replace (case when cast(encounter_id as bigint) % 30 <> 0 then patient_id end as patient_id)
    from ({ENCOUNTERS})"""

STRANGERS = f"""
    select * replace (case when cast(claim_id as bigint) % 20 = 3 then 'X' || member_id
                           else member_id end as member_id)
    from ({CLAIMS})"""


def _blank(column: str) -> str:
    return f"({column} is null or trim(cast({column} as varchar)) = '')"


def _below_zero(column: str) -> str:
    return f"coalesce(try_cast({column} as double) < 0, false)"


CLAIMS_FILLED = ["claim_id", "member_id", "provider_id", "service_date"]
CLAIMS_AMOUNTS = ["paid_amount", "allowed_amount"]
VISITS_FILLED = ["patient_id", "encounter_id", "encounter_date"]

MISSING = " or ".join(map(_blank, CLAIMS_FILLED))
NEGATIVE = " or ".join(map(_below_zero, CLAIMS_AMOUNTS))
VISIT_MISSING = " or ".join(map(_blank, VISITS_FILLED))


def _reasons(missing: list[str], negative: list[str]) -> str:
    named = [f"case when {_blank(c)} then 'not_null_{c}' end" for c in missing]
    named += [f"case when {_below_zero(c)} then 'non_negative_{c}' end" for c in negative]
    return f"concat_ws(',', {', '.join(named)})"


def _tidy(view: str, *codes: str) -> str:
    cleaned = ", ".join(f"upper(trim({c})) as {c}" for c in codes)
    return f"select * replace ({cleaned}) from ({view})"


def _one_per(view: str, keys: list[str], others: list[str]) -> str:
    order = ", ".join(f"{c} desc nulls last" for c in others)
    return f"""
    select * from ({view})
    qualify row_number() over (partition by {', '.join(keys)} order by {order}) = 1"""


CLAIM_OTHERS = ["member_id", "provider_id", "paid_amount", "allowed_amount", "icd10_code", "cpt_code"]
VISIT_OTHERS = ["patient_id", "provider_id", "encounter_date", "diagnosis_code", "procedure_code"]
LINE_OTHERS = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]

TIDY_CLAIMS = _tidy(CLAIMS, "icd10_code", "cpt_code")
TIDY_VISITS = _tidy(ENCOUNTERS, "diagnosis_code", "procedure_code")
TIDY_GAPPY = _tidy(GAPPY, "diagnosis_code", "procedure_code")


def _clean_claims(tidy: str = TIDY_CLAIMS) -> str:
    good = f"select * from ({tidy}) where not ({MISSING}) and not ({NEGATIVE})"
    return _one_per(good, ["claim_id", "service_date"], CLAIM_OTHERS)


def _clean_visits(tidy: str) -> str:
    return _one_per(f"select * from ({tidy}) where not ({VISIT_MISSING})", ["encounter_id"], VISIT_OTHERS)


def _key(column: str) -> str:
    return f"case when {column} is not null then sha256({column} || '||{SALT}') end"


MAPPING = f"select distinct patient_id, {_key('patient_id')} as member_key from ({PATIENTS}) where patient_id is not null"
SAFE_PATIENTS = f"select gender, {_key('patient_id')} as member_key from ({PATIENTS})"
SAFE_GAPPY_PATIENTS = f"select gender, {_key('patient_id')} as member_key from ({GAPPY_PATIENTS})"


def _masked(view: str, id_column: str) -> str:
    return f"""
    select d.* exclude ({id_column}), m.member_key
    from ({view}) d left join ({MAPPING}) m on d.{id_column} = m.patient_id"""


# The whole way to the star schema as common table expressions; each query selects from the end it needs.
def _star(claims: str = _clean_claims(), same_diagnosis: str = "=", visits: str = TIDY_VISITS) -> str:
    return f"""
with claims as ({_masked(claims, "member_id")}),
     patients as ({SAFE_GAPPY_PATIENTS}),
     visits as ({_masked(_clean_visits(visits), "patient_id")}),
     integrated as (
         select c.*, v.diagnosis_code, v.procedure_code, v.encounter_date,
                coalesce(c.icd10_code, v.diagnosis_code) as final_diagnosis,
                coalesce(c.cpt_code, v.procedure_code) as final_procedure
         from claims c left join visits v on c.member_key = v.member_key),
     dim_member as (
         select member_key, gender, cast(row_number() over (order by member_key nulls last) as bigint) as member_sk
         from (select member_key, min(gender) as gender from patients where member_key is not null group by member_key)),
     dim_provider as (
         select provider_id, cast(row_number() over (order by provider_id nulls last) as bigint) as provider_sk
         from (select distinct provider_id from integrated)),
     dim_diagnosis as (
         select final_diagnosis,
                cast(row_number() over (order by final_diagnosis nulls last) as bigint) as diagnosis_sk
         from (select distinct final_diagnosis from integrated)),
     dim_date as (
         select service_date as date,
                cast(year(service_date) as integer) as year,
                cast(month(service_date) as integer) as month,
                cast(day(service_date) as integer) as day,
                cast(row_number() over (order by service_date) as bigint) as date_sk
         from (select distinct service_date from integrated where service_date is not null)),
     fact_claims as (
         select i.claim_id, m.member_sk, p.provider_sk, g.diagnosis_sk, d.date_sk,
                i.paid_amount, i.allowed_amount, i.final_procedure
         from integrated i
         left join dim_member m on i.member_key = m.member_key
         left join dim_provider p on i.provider_id = p.provider_id
         left join dim_diagnosis g on i.final_diagnosis {same_diagnosis} g.final_diagnosis
         left join dim_date d on i.service_date = d.date)
"""


STAR = _star()
# With the encounters dealt over the years of the claims.
YEARS_STAR = _star(
    visits=f"""select * replace (cast(date '1992-01-01' + cast(cast(encounter_id as bigint) * 37 % 2500 as integer) as date) as encounter_date)
               from ({TIDY_VISITS})"""
)
FED_STAR = _star(_clean_claims(_tidy(READ_CLAIMS, "icd10_code", "cpt_code")))

_NEAREST = """
    select * from (
        select c.* exclude (procedure_code), v.diagnosis_code, v.procedure_code,
               row_number() over (
                   partition by c.claim_id, c.service_date
                   order by v.encounter_id is null, coalesce(abs(c.service_date - v.encounter_date), 1 << 30), v.encounter_id
               ) as place
        from (select *, null as procedure_code from claims) c left join visits v on c.member_key = v.member_key)
    where place = 1"""
FACT_BY_CLAIM = STAR + f"""
    select n.claim_id, m.member_sk, p.provider_sk, g.diagnosis_sk, d.date_sk, n.paid_amount, n.allowed_amount,
           coalesce(n.cpt_code, n.procedure_code) as final_procedure
    from ({_NEAREST}) n
    left join dim_member m on n.member_key = m.member_key
    left join dim_provider p on n.provider_id = p.provider_id
    left join dim_diagnosis g on coalesce(n.icd10_code, n.diagnosis_code) = g.final_diagnosis
    left join dim_date d on n.service_date = d.date"""


def _asof(columns: str, sign: str, far: str) -> str:
    """One encounter per member and day, the least by id, joined as of the day of the claim."""
    return YEARS_STAR + f"""
    , days as (
        select * from (select *, row_number() over (partition by member_key, encounter_date order by encounter_id) as place from visits
                       where member_key is not null and encounter_date is not null)
        where place = 1)
    select c.claim_id, c.service_date, c.member_key, {columns.format(far=far)}
    from claims c asof left join days v on c.member_key = v.member_key and c.service_date {sign} v.encounter_date"""


def _two_days(table: str, key: str, first: str, every: str) -> str:
    """Numbers given on a first day in order, and behind them those that the second day adds."""
    return f"""{table} as (
        select {key}, cast(row_number() over (order by not early, {key} nulls last) as bigint) as sk
        from (select e.{key}, exists (select 1 from ({first}) f where f.{key} is not distinct from e.{key}) as early
              from (select distinct {key} from ({every})) e))"""


_DAY_ONE = "service_date < date '1995-01-01'"
_NEAREST_FINAL = f"select *, coalesce(icd10_code, diagnosis_code) as final_diagnosis from ({_NEAREST})"
# The dimension holds the diagnoses of every encounter of a member, not only of the nearest.
DAILY_FACT = YEARS_STAR + f""",
    {_two_days("two_providers", "provider_id", f"select provider_id from claims where {_DAY_ONE}", "select provider_id from claims")},
    {_two_days("two_diagnoses", "final_diagnosis", f"select final_diagnosis from integrated where {_DAY_ONE}", "select final_diagnosis from integrated")},
    {_two_days("two_dates", "service_date", f"select service_date from claims where {_DAY_ONE}", "select service_date from claims")}
    select n.claim_id, m.member_sk, p.sk as provider_sk, g.sk as diagnosis_sk, d.sk as date_sk, n.paid_amount, n.allowed_amount,
           coalesce(n.cpt_code, n.procedure_code) as final_procedure
    from ({_NEAREST_FINAL}) n
    left join dim_member m on n.member_key = m.member_key
    left join two_providers p on n.provider_id = p.provider_id
    left join two_diagnoses g on n.final_diagnosis = g.final_diagnosis
    left join two_dates d on n.service_date = d.service_date"""


_THRICE = " union all ".join([f"select icd10_code, cpt_code, provider_id from ({CLAIMS}) where paid_amount < 0"] * 3)


def _profile(view: str, columns: list[str]) -> str:
    """Values that fit each type, counted; a type fits if it fits all filled values."""

    def one(name: str) -> str:
        text = name == "zip" or name.endswith(("_id", "_code"))
        kinds = {
            "date": "regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') and try_cast(v as date) is not null",
            "bigint": "regexp_matches(v, '^-?(0|[1-9][0-9]{0,17})$')",
            "double": "try_cast(v as double) is not null and not regexp_matches(v, '^-?0[0-9]') and regexp_matches(v, '[0-9]')",
        }
        cases = " ".join(f"when count(v) > 0 and bool_and({test}) then '{kind}'" for kind, test in kinds.items())
        return f"""select '{name}' as column_name, count(v) as filled, count(*) - count(v) as empty,
                          cast(coalesce(max(length(x)), 0) as integer) as longest,
                          {"'string'" if text else f"case {cases} else 'string' end"} as type
                   from (select {name} as x, case when trim({name}) <> '' then trim({name}) end as v from ({view}))"""

    return " union all ".join(map(one, columns))


_FEED = f"""
    select claim_id, member_id, provider_id,
           case when cast(claim_id as bigint) % 37 = 3 then 'on ' || strftime(service_date, '%Y-%m-%d')
                else strftime(service_date, '%Y-%m-%d') end as service_date,
           icd10_code, cpt_code
    from ({CLAIMS})"""
_PATIENT_TEXT = f"select patient_id, zip, strftime(dob, '%Y-%m-%d') as dob, gender from ({GAPPY_PATIENTS})"
_YEARS = YEARS_STAR + ", days as (select *, cast(year(service_date) as integer) as year from claims where service_date is not null)"


def _episodes(gap: int) -> str:
    """Days of a member that follow one another within the gap, by lag and running sum."""
    return f""",
    days as (
        select member_key, encounter_date as day, count(*) as encounters from visits
        where member_key is not null and encounter_date is not null group by 1, 2),
    started as (
        select *, case when day - lag(day) over (partition by member_key order by day) <= {gap} then 0 else 1 end as start from days),
    numbered as (select *, sum(start) over (partition by member_key order by day) as episode from started),
    episodes as (
        select member_key, min(day) as first_day, max(day) as last_day, count(*) as days, cast(sum(encounters) as bigint) as encounters
        from numbered group by member_key, episode)
    """


def _totals(dims: list[str], grouping: str, measures: list[str]) -> str:
    """Totals over distinct claims: within each group a claim's amounts are taken once."""
    amounts = ", ".join(f"'{m}': cast(f.{m} as decimal(18, 2))" for m in measures)
    sums = ", ".join(f"cast(list_sum(list_transform(found, lambda x: x.{m})) as double) as {m}" for m in measures)
    return STAR + f"""
    , named as (
        select f.*, p.provider_id, g.final_diagnosis, d.year, d.month from fact_claims f
        left join dim_provider p on f.provider_sk = p.provider_sk
        left join dim_diagnosis g on f.diagnosis_sk = g.diagnosis_sk
        left join dim_date d on f.date_sk = d.date_sk),
    grouped as (
        select {', '.join(dims)}, {f"cast(grouping({', '.join(dims)}) as integer)" if grouping else "0"} as level,
               list(distinct {{'claim': f.claim_id, 'date': f.date_sk, {amounts}}}) as found
        from named f group by {f"{grouping} ({', '.join(dims)})" if grouping else ', '.join(dims)})
    select {', '.join(dims)}, level, cast(len(found) as bigint) as claims, {sums} from grouped"""


def _count_if(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def _checks(source: str, table: str, key: str | None, filled: list[str], lengths: dict[str, int]) -> str:
    def row(check: str, column: str, violations: str) -> str:
        return f"""select '{table}' as table_name, '{check}' as check_name, '{column}' as column_name,
                   cast({violations} as bigint) as violations from {source}"""

    parts = [row("not_null", c, _count_if(f"{c} is null")) for c in ([key] if key else []) + filled]
    parts += [row("max_length", c, _count_if(f"length({c}) > {size}")) for c, size in lengths.items()]
    if key:
        parts.append(row("primary_key", key, f"count({key}) - count(distinct {key})"))
    return " union all ".join(parts)


OFFERED = f"""(select cast(provider_id as bigint) as member_sk, member_id as member_key, cpt_code as gender
               from ({CLAIMS}))"""

_NEGATIVE_CODES = f"select icd10_code, cpt_code, provider_id from ({CLAIMS}) where paid_amount < 0"

ORACLES: dict[str, str] = {
    "scan_parquet": "select * from orders",
    "parquet_roundtrip": CLAIMS,
    "contract_violations": _checks(
        OFFERED, "dim_member", "member_sk", ["member_key"], {"member_key": 64, "gender": 10}
    ),
    "contract_star": STAR
    + " union all ".join(
        [
            _checks("dim_member", "dim_member", "member_sk", ["member_key"], {"member_key": 64, "gender": 10}),
            _checks("dim_provider", "dim_provider", "provider_sk", ["provider_id"], {"provider_id": 32}),
            _checks("dim_diagnosis", "dim_diagnosis", "diagnosis_sk", [], {"final_diagnosis": 32}),
            _checks("dim_date", "dim_date", "date_sk", [], {}),
            _checks("fact_claims", "fact_claims", None, [], {"claim_id": 32, "final_procedure": 32}),
        ]
    ),
    "project_columns": f"select claim_id, paid_amount, allowed_amount from ({CLAIMS})",
    "project_rename": f"select patient_id as member_id, gender from ({PATIENTS})",
    "derive_column": f"""
        select *, cast(year(service_date) as integer) as year, cast(month(service_date) as integer) as month,
               cast(day(service_date) as integer) as day
        from ({CLAIMS})""",
    "drop_columns": f"""
        select encounter_id, encounter_date, diagnosis_code, procedure_code from ({ENCOUNTERS})""",
    "filter_null_or_blank": f"select * from ({CLAIMS}) where {_blank('member_id')}",
    "filter_negative": "select * from customer where c_acctbal < 0",
    "filter_not_null": f"select service_date from ({CLAIMS}) where service_date is not null",
    "scalar_standardize": f"select claim_id, upper(trim(icd10_code)) as code from ({CLAIMS})",
    "scalar_dates": f"""
        select claim_id, day_read, cast(year(day_read) as integer) as year,
               cast(month(day_read) as integer) as month, cast(day(day_read) as integer) as day
        from (select claim_id, case when cast(claim_id as bigint) % 13 <> 0 then service_date end as day_read
              from ({CLAIMS}))""",
    "scalar_cast": f"""
        select claim_id, try_cast(member_id as double) as member_number, try_cast(cpt_code as double) as code_number
        from ({CLAIMS})""",
    "scalar_hash": f"select claim_id, sha256(concat_ws('||', member_id, '{SALT}')) as digest from ({CLAIMS})",
    "scalar_coalesce": f"select claim_id, coalesce(icd10_code, cpt_code) as code from ({CLAIMS})",
    "member_key": f"select claim_id, {_key('member_id')} as member_key from ({CLAIMS})",
    "distinct_rows": "select distinct l_returnflag, l_linestatus, l_linenumber from lineitem",
    "dedup_lines": _one_per("select * from lineitem", ["l_orderkey", "l_linenumber"], LINE_OTHERS),
    "dedup_claims": _one_per(
        f"""select * from ({CLAIMS}) union all
            select * replace (paid_amount + 1 as paid_amount) from ({CLAIMS})""",
        ["claim_id", "service_date"],
        CLAIM_OTHERS,
    ),
    "dedup_encounters": _one_per(
        f"""select * from ({ENCOUNTERS}) union all
            select * replace (cast(null as varchar) as procedure_code) from ({ENCOUNTERS})""",
        ["encounter_id"],
        VISIT_OTHERS,
    ),
    "union_by_name": f"""
        select member_id, provider_id from ({CLAIMS}) union all
        select patient_id, provider_id from ({ENCOUNTERS})""",
    "except_rows": f"select icd10_code, cpt_code, provider_id from ({CLAIMS}) except {_NEGATIVE_CODES}",
    "join_left_anti": f"""
        select * from ({CLAIMS}) c
        where not exists (select 1 from ({ENCOUNTERS}) v where v.patient_id = c.member_id)""",
    "standardize_codes": TIDY_CLAIMS,
    "normalize_dates": f"""
        select * replace (case when cast(encounter_id as bigint) % 17 <> 0 then encounter_date end as encounter_date)
        from ({ENCOUNTERS})""",
    "dq_not_null_good": f"select * from ({CLAIMS}) where not ({MISSING})",
    "dq_not_null_bad": f"select * from ({CLAIMS}) where {MISSING}",
    "dq_non_negative_good": f"select * from ({CLAIMS}) where not ({NEGATIVE})",
    "dq_non_negative_bad": f"select * from ({CLAIMS}) where {NEGATIVE}",
    "dq_claims_good": f"select * from ({CLAIMS}) where not ({MISSING}) and not ({NEGATIVE})",
    "dq_encounters_good": f"select * from ({GAPPY}) where not ({VISIT_MISSING})",
    "dq_claims_quarantine": f"""
        select *, 'claims_dq_failed' as reason, {_reasons(CLAIMS_FILLED, CLAIMS_AMOUNTS)} as reasons
        from ({CLAIMS}) where {MISSING} or {NEGATIVE}""",
    "dq_encounters_quarantine": f"""
        select *, 'ehr_dq_failed' as reason, {_reasons(VISITS_FILLED, [])} as reasons
        from ({TIDY_GAPPY}) where {VISIT_MISSING}""",
    "dq_summary": f"""
        select count(*) as rows_in, {_count_if(f'not ({MISSING}) and not ({NEGATIVE})')} as rows_good,
               {_count_if(f'({MISSING}) or ({NEGATIVE})')} as rows_bad,
               {', '.join(f'{_count_if(_blank(c))} as failed_not_null_{c}' for c in CLAIMS_FILLED)},
               {', '.join(f'{_count_if(_below_zero(c))} as failed_non_negative_{c}' for c in CLAIMS_AMOUNTS)}
        from ({CLAIMS})""",
    "curate_claims": _clean_claims(),
    "curate_encounters": _clean_visits(TIDY_GAPPY),
    "deidentify_patients": SAFE_PATIENTS,
    "mask_claims": _masked(STRANGERS, "member_id"),
    "mask_encounters": _masked(GAPPY, "patient_id"),
    "integrate_claims": STAR + "select * from integrated",
    "dim_member": STAR + "select * from dim_member",
    "dim_provider": STAR + "select * from dim_provider",
    "dim_diagnosis": STAR + "select * from dim_diagnosis",
    "dim_date": STAR + "select * from dim_date",
    "lookup_member": STAR
    + "select c.claim_id, c.member_key, m.member_sk from claims c left join dim_member m on c.member_key = m.member_key",
    "lookup_provider": STAR
    + """select c.claim_id, c.provider_id, p.provider_sk
         from claims c left join dim_provider p on c.provider_id = p.provider_id""",
    "lookup_diagnosis": STAR
    + """select c.claim_id, c.icd10_code as final_diagnosis, g.diagnosis_sk
         from claims c left join dim_diagnosis g on c.icd10_code = g.final_diagnosis""",
    "lookup_date": STAR
    + """select c.claim_id, c.service_date, d.date_sk
         from claims c left join dim_date d on c.service_date = d.date""",
    "fact_claims": STAR + "select * from fact_claims",
    "csv_claims": f"""
        select *, cast(claim_id as bigint) % 31 = 5 as paid_unread from ({READ_WITH_TEXT})""",
    "csv_unread_values": f"""
        select count(*) as rows_in, {_count_if('cast(claim_id as bigint) % 37 = 3 and service_date is not null')} as unread_service_date,
               {_count_if('cast(claim_id as bigint) % 31 = 5')} as unread_paid_amount, cast(0 as bigint) as unread_allowed_amount
        from ({CLAIMS})""",
    "pipeline_quarantine": f"""
        select *, 'claims_dq_failed' as reason, {_reasons(CLAIMS_FILLED, ["paid_amount"])} as reasons
        from ({_tidy(READ_WITH_TEXT, "icd10_code", "cpt_code")}) where {MISSING} or {_below_zero("paid_amount")}""",
    "pipeline_safe_claims": FED_STAR + "select * from claims",
    "pipeline_fact": FED_STAR + "select * from fact_claims",
    "split_no_rules": CLAIMS,
    "rules_on_absent_column": f"""
        select * exclude (allowed_amount) from ({CLAIMS}) where not ({MISSING}) and not ({_below_zero("paid_amount")})""",
    "dim_member_ranges": STAR + "select * from dim_member",
    "dim_two_columns": f"""
        select zip, gender, last_name, first_name,
               cast(row_number() over (order by zip nulls last, gender nulls last) as bigint) as patient_group_sk
        from (select *, row_number() over (partition by zip, gender order by last_name nulls last, first_name nulls last) as place
              from ({GAPPY_PATIENTS}))
        where place = 1""",
    "fact_claims_null_safe": _star(same_diagnosis="is not distinct from") + "select * from fact_claims",
    "fact_claims_by_claim": FACT_BY_CLAIM,
    "asof_encounter": _asof(
        "case when {far} then v.encounter_id end as encounter_id, case when {far} then v.encounter_date end as encounter_date, "
        "case when {far} then v.diagnosis_code end as diagnosis_code",
        ">=",
        "c.service_date - v.encounter_date <= 30",
    ),
    "asof_next_encounter": _asof("v.encounter_id, v.encounter_date", "<=", ""),
    "daily_dim_member": STAR
    + f"""
    select d.member_key, gender, cast(row_number() over (order by d.member_key >= '8', d.member_key) as bigint) as member_sk
    from dim_member d""",
    "daily_fact": DAILY_FACT,
    "load_only_new": CLAIMS,
    "paid_by_diagnosis_and_month": _totals(["final_diagnosis", "year", "month"], "rollup", ["paid_amount", "allowed_amount"]),
    "profile_claims": _profile(_FEED, ["claim_id", "member_id", "provider_id", "service_date", "icd10_code", "cpt_code"]),
    "profile_patients": _profile(_PATIENT_TEXT, ["patient_id", "zip", "dob", "gender"]),
    "paid_quantiles": _YEARS
    + """
        select year, share, list_sort(list(paid_amount))[greatest(cast(ceil(share * count(*)) as bigint), 1)] as paid, true as within
        from days, (select unnest([0.1::double, 0.5::double, 0.9::double, 0.99::double]) as share) group by year, share""",
    "members_per_year": _YEARS + "select year, count(distinct member_key) as members, true as within from days group by year",
    "fact_by_month": STAR
    + """
        select f.* replace (case when strftime(d.date, '%Y-%m') = '1995-03' then paid_amount * 2 else paid_amount end as paid_amount),
               coalesce(strftime(d.date, '%Y-%m'), 'none') as month
        from fact_claims f left join dim_date d on f.date_sk = d.date_sk""",
    "top_providers": f"""
        select * exclude (level, place), cast(place as integer) as rank from (
            select *, row_number() over (partition by year, month order by paid_amount desc, provider_id nulls last) as place
            from ({_totals(["year", "month", "provider_id"], "", ["paid_amount"])}))
        where place <= 3""",
    "except_all_rows": f"select icd10_code, cpt_code, provider_id from ({CLAIMS}) except all ({_THRICE})",
    "intersect_all_rows": f"select icd10_code, cpt_code, provider_id from ({CLAIMS}) intersect all ({_THRICE})",
    "episodes_of_care": YEARS_STAR + _episodes(7) + "select * from episodes",
    "episodes_of_care_in_ranges": YEARS_STAR + _episodes(3) + "select * from episodes",
    "episodes_streamed": YEARS_STAR + _episodes(7) + "select * exclude (days) from episodes",
    "claims_in_episodes": YEARS_STAR
    + _episodes(30)
    + """select c.claim_id, c.service_date, c.member_key, e.first_day, e.last_day, e.encounters
         from claims c join episodes e on c.member_key = e.member_key and c.service_date between e.first_day and e.last_day""",
    "claims_in_long_periods": YEARS_STAR
    + """, periods as (
             select member_key, cast(min(encounter_date) + 300 as date) as first_day, cast(max(encounter_date) - 300 as date) as last_day
             from visits where member_key is not null group by member_key)
         select c.claim_id, c.service_date, c.member_key, p.first_day, p.last_day
         from claims c left join periods p on c.member_key = p.member_key and c.service_date between p.first_day and p.last_day""",
    "stream_good": _clean_claims(_tidy(
        f"""select * from ({CLAIMS}) union all
            select * replace (paid_amount + 1 as paid_amount) from ({CLAIMS}) where cast(claim_id as bigint) % 3 = 0""",
        "icd10_code",
        "cpt_code",
    )),
    "stream_quarantine": f"""
        with tidy as (select * from ({TIDY_CLAIMS})),
             good as (select * from tidy where not ({MISSING}) and not ({NEGATIVE}))
        select *, 'claims_dq_failed' as reason, {_reasons(CLAIMS_FILLED, CLAIMS_AMOUNTS)} as reasons
        from tidy where {MISSING} or {NEGATIVE}
        union all
        select *, 'claims_dq_failed' as reason, 'late' as reasons from good
        where cast(claim_id as bigint) % 2 = 1
          and service_date < (select max(service_date) from good where cast(claim_id as bigint) % 2 = 0) - 365""",
    "paid_cube": _totals(["final_diagnosis", "provider_id", "final_procedure"], "cube", ["paid_amount"]),
}
ORACLES |= {
    f"{name}_spread": ORACLES[name] for name in ("integrate_claims", "fact_claims", "mask_claims", "join_left_anti")
}
