"""Product documents -> typed catalog rows, parameter rows and rejects.

One projection over the parsed documents (no shuffle): alias mapping,
lax coercion, falsy defaults, 0/1 flags, category fallback, JSON text for
nested lists, optional raw document, and a reject flag with its reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partsmith import schemas as S
from partsmith.functions import coerce as C
from partsmith.sources.documents import doc_value_sql as _doc_value_sql
from partsmith.sources.documents import parse_documents
from partsmith.sources.documents import raw_key_sql as _raw_key_sql


def _q(name: str) -> str:
    return "`" + name + "`"


def _not_text(column: str) -> str:
    """A text column's value came as another JSON type."""
    keys = ", ".join(f"'{k}'" for k in dict.fromkeys([S.doc_key(column), column]))
    return f"coalesce(arrays_overlap(__not_text, array({keys})), false)"


def records_from_documents(docs: DataFrame, include_raw_json: bool = True,
                           doc_col: str = "doc", keep_doc: str | None = None) -> DataFrame:
    """Typed product records.

    Output: every canonical product column, plus ``product_id``, ``params``
    (array of name/value structs, already falling back en -> local -> ""),
    ``rejected`` and ``reject_reason``, and every non-document input column
    (e.g. ``page``/``pos`` order columns); ``keep_doc`` names a column for the document
    itself.

    Three projections (raw strings -> typed values -> defaults and reject
    flags); each typed value is defined once and shared by the column and its
    reject check.  They run in one stage without a shuffle.  Each projection is one
    ``selectExpr`` of SQL expressions (see ``functions.coerce``)."""
    parsed = parse_documents(docs, doc_col)
    carry = [c for c in docs.columns if c != doc_col]
    keep = [_q(c) for c in carry]
    types = dict((n, t) for n, t, _ in S.PRODUCT_FIELDS)
    doc_cols = [c for c in S.PRODUCT_COLUMNS
                if c not in S.VENDOR_COLUMNS and c not in ("last_updated", "raw_json")]

    # 1. raw (string) values under canonical names
    raw = []
    for c in doc_cols:
        if c == "category_id":
            raw.append(f"coalesce({_raw_key_sql(S.DOC_CATALOG_ID)}, {_raw_key_sql('catalog_id')})"
                       " AS r__catalog_id")
            raw.append(f"coalesce({_raw_key_sql(S.DOC_WM_CATALOG_ID)}, "
                       f"{_raw_key_sql('wm_catalog_id')}) AS r__wm_catalog_id")
        elif c == "price_ladder":
            raw.append(f"{_doc_value_sql(c)} AS v__{c}")
        else:
            raw.append(f"{_doc_value_sql(c)} AS r__{c}")
    raw.append(f"coalesce({_raw_key_sql(S.DOC_PRODUCT_ID)}, {_raw_key_sql('product_id')})"
               " AS r__product_id")
    raw.append(f"coalesce({_raw_key_sql(S.DOC_PARAMS)}, {_raw_key_sql('params')}) AS r__params")
    for c in S.REQUIRED_DOC_STRINGS:
        # explicit null vs absent key: only looked up when the value is NULL
        keys = ", ".join(f"'{k}'" for k in dict.fromkeys([S.doc_key(c), c]))
        raw.append(f"CASE WHEN {_doc_value_sql(c)} IS NULL THEN "
                   f"coalesce(arrays_overlap(doc_keys, array({keys})), false) ELSE false END"
                   f" AS n__{c}")
    stage1 = parsed.selectExpr(*keep, _q(doc_col), "doc_keys IS NULL AS __unparsable",
                               "not_text AS __not_text", *raw)

    # 2. typed values (each coercion once)
    typed = []
    for c in doc_cols:
        dtype = types[c]
        r = f"r__{c}"
        if c == "category_id":
            typed.append(f"{C.lax_long_sql('r__catalog_id')} AS t__catalog_id")
            typed.append(f"{C.lax_long_sql('r__wm_catalog_id')} AS t__wm_catalog_id")
        elif c == "price_ladder":
            typed.append(f"{C.ladder_texts_sql(f'v__{c}', S.PRICE_KEYS)} AS {r}")
        elif c == "product_images":
            continue
        elif c in S.FLAG_COLUMNS:
            typed.append(f"{C.lax_bool_sql(r)} AS t__{c}")
        elif isinstance(dtype, T.LongType):
            typed.append(f"{C.lax_long_sql(r)} AS t__{c}")
        elif isinstance(dtype, T.DoubleType):
            typed.append(f"{C.lax_double_sql(r)} AS t__{c}")
    typed.append(f"{C.lax_long_sql('r__product_id')} AS t__product_id")
    stage2 = (stage1.selectExpr("*", *typed)
              .selectExpr("*", f"{C.ladder_typed_sql('r__price_ladder')} AS t__price_ladder"))

    # 3. defaults, flags, JSON text, reject reason
    cols: list[str] = []
    failures: list[tuple[str, str]] = []
    for c in S.PRODUCT_COLUMNS:
        dtype = types[c]
        st = dtype.simpleString()
        if c in S.VENDOR_COLUMNS:
            cols.append(f"CAST({'0' if c == 'vendor_stock' else 'NULL'} AS {st}) AS {c}")
        elif c == "last_updated":
            cols.append(f"CAST(NULL AS {st}) AS {c}")
        elif c == "raw_json":
            cols.append(f"CAST({_q(doc_col) if include_raw_json else 'NULL'} AS STRING) AS {c}")
        elif c == "category_id":
            failures.append((S.DOC_CATALOG_ID, C.coercion_failed_sql("r__catalog_id", "t__catalog_id")))
            failures.append((S.DOC_WM_CATALOG_ID,
                             C.coercion_failed_sql("r__wm_catalog_id", "t__wm_catalog_id")))
            cols.append(f"{C.first_nonzero_sql('t__catalog_id', 't__wm_catalog_id')} AS {c}")
        elif c == "price_ladder":
            r, tv = f"r__{c}", f"t__{c}"
            bad = (f"coalesce(exists(arrays_zip({r}, {tv}), z -> "
                   f"(z.{r}.ladder IS NOT NULL AND z.{tv}.ladder IS NULL) OR "
                   f"(z.{r}.usdPrice IS NOT NULL AND z.{tv}.usdPrice IS NULL)), false)")
            failures.append((S.doc_key(c), bad))
            cols.append(f"{C.ladder_json_sql(tv)} AS {c}")
        elif c == "product_images":
            cols.append(f"coalesce(r__{c}, '[]') AS {c}")
        elif c in S.FLAG_COLUMNS:
            failures.append((S.doc_key(c), C.coercion_failed_sql(f"r__{c}", f"t__{c}")))
            cols.append(f"{C.flag01_sql(f't__{c}')} AS {c}")
        elif isinstance(dtype, (T.LongType, T.DoubleType)):
            failures.append((S.doc_key(c), C.coercion_failed_sql(f"r__{c}", f"t__{c}")))
            v = f"t__{c}"
            if c in S.FALSY_DEFAULTS:
                v = C.falsy_default_sql(v, S.FALSY_DEFAULTS[c])
            cols.append(f"{v} AS {c}")
        elif c in S.REQUIRED_DOC_STRINGS:
            failures.append((S.doc_key(c), f"(n__{c} OR {_not_text(c)})"))
            cols.append(f"coalesce(r__{c}, '') AS {c}")
        else:
            failures.append((S.doc_key(c), _not_text(c)))
            cols.append(f"r__{c} AS {c}")
    failures.append((S.DOC_PRODUCT_ID, C.coercion_failed_sql("r__product_id", "t__product_id")))
    params = ("transform(coalesce(r__params, array()), p -> named_struct("
              f"'param_name', {C.first_nonempty_sql('p.paramNameEn', 'p.paramName')}, "
              f"'param_value', {C.first_nonempty_sql('p.paramValueEn', 'p.paramValue')})) AS params")
    reason = "concat_ws(',', " + ", ".join(
        f"CASE WHEN {pred} THEN '{name}' END" for name, pred in failures) + ") AS __reason"
    doc = [f"{_q(doc_col)} AS {_q(keep_doc)}"] if keep_doc else []
    stage3 = stage2.selectExpr(*keep, *doc, "__unparsable", *cols, "t__product_id AS product_id",
                               params, reason)
    return stage3.selectExpr(
        *[_q(c) for c in stage3.columns if c not in ("__unparsable", "__reason")],
        "__unparsable OR __reason <> '' AS rejected",
        "CASE WHEN __unparsable THEN 'unparsable' WHEN __reason <> '' THEN __reason END"
        " AS reject_reason")


def _accepted(records: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """Accepted records that have a key, with ``cols`` and the carried
    columns ``keep``.

    The values and the reject flag are produced once: an ``inline`` generator
    boundary keeps the reject filter from being pushed below the coercion
    projections (where it would evaluate every coercion a second time).  The
    carried columns pass beside the generator, so later filters on them (a
    batch's time range, say) still reach the scan."""
    gen = records.select(*keep, F.inline(F.array(F.struct(*cols, "rejected"))))
    return (gen.filter(~F.col("rejected") & (F.coalesce(F.col("sku"), F.lit("")) != ""))
            .drop("rejected"))


def catalog_rows(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Accepted records with a key: the rows an upsert writes (empty keys are
    dropped, rejects are not rows)."""
    keep = keep or []
    return _accepted(records, S.PRODUCT_COLUMNS, keep).select(*S.PRODUCT_COLUMNS, *keep)


def accepted_keys(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Keys of the accepted records (one row per record), with ``keep``."""
    return _accepted(records, ["sku"], keep or [])


def drop_keyless(df: DataFrame, key: str = S.PRODUCT_KEY) -> DataFrame:
    """Records without a key never become rows."""
    return df.filter(F.coalesce(F.col(key), F.lit("")) != "")


def params_rows(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Parameter child rows of accepted, keyed records; a parameter is kept only
    when both its name and value are non-empty."""
    keep = keep or []
    base = _accepted(records, ["sku", "params"], keep)
    return (base.select("sku", *keep, F.posexplode("params").alias("param_pos", "p"))
            .filter((F.col("p.param_name") != "") & (F.col("p.param_value") != ""))
            .select("sku", *keep, "param_pos",
                    F.col("p.param_name").alias("param_name"),
                    F.col("p.param_value").alias("param_value")))
