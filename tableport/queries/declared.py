"""Declared columns, keys and references of the test tables."""

from ..operators.constraints import Check, Constraints, ForeignKey, Key

# Columns in catalog order; i = int, b = bigint, s = string, d = double, t = timestamp, a = array.
COLUMNS = {
    "region": "r_regionkey:i r_name:s",
    "nation": "n_nationkey:i n_name:s n_regionkey:i",
    "customer": "c_custkey:b c_name:s c_nationkey:i c_acctbal:d c_mktsegment:s",
    "supplier": "s_suppkey:b s_name:s s_nationkey:i s_acctbal:d",
    "part": "p_partkey:b p_name:s p_brand:s p_type:s p_size:i p_retailprice:d",
    "orders": "o_orderkey:b o_custkey:b o_orderstatus:s o_totalprice:d o_orderdate:t o_orderpriority:s",
    "lineitem": "l_orderkey:b l_partkey:b l_suppkey:b l_linenumber:i l_quantity:d l_extendedprice:d "
                "l_discount:d l_tax:d l_returnflag:s l_linestatus:s l_shipdate:t",
    "events": "event_id:b ts:t user_id:b event_type:s value:d props:s",
    "documents": "doc_id:b text:s lang:s source:s n_chars:b",
    "embeddings": "vec_id:b embedding:a label:i",
    "pages": "page_id:b url:s html:s",
    "benchmark": "item_id:b text:s",
    "labels": "doc_id:b quality:i toxic:i",
    "conversations": "conv_id:b turn:b role:s text:s",
}
COLUMNS = {t: [tuple(c.split(":")) for c in text.split()] for t, text in COLUMNS.items()}
TYPE_TEXT = {"i": "int", "b": "bigint", "s": "string", "d": "double", "t": "timestamp_ntz",
             "a": "array<float>"}

KEYS = tuple(
    Key(t, ("l_orderkey", "l_linenumber") if t == "lineitem" else
        ("conv_id", "turn") if t == "conversations" else (cols[0][0],))
    for t, cols in COLUMNS.items())
FOREIGN_KEYS = (
    ForeignKey("fk_nation_region", "nation", ("n_regionkey",), "region", ("r_regionkey",)),
    ForeignKey("fk_customer_nation", "customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    ForeignKey("fk_supplier_nation", "supplier", ("s_nationkey",), "nation", ("n_nationkey",)),
    ForeignKey("fk_orders_customer", "orders", ("o_custkey",), "customer", ("c_custkey",)),
    ForeignKey("fk_lineitem_orders", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",), "CASCADE"),
    ForeignKey("fk_lineitem_part", "lineitem", ("l_partkey",), "part", ("p_partkey",)),
    ForeignKey("fk_lineitem_supplier", "lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
    ForeignKey("fk_labels_documents", "labels", ("doc_id",), "documents", ("doc_id",), "SET_NULL"),
)
CHECKS = (
    Check("ck_quantity", "lineitem", "l_quantity BETWEEN 1 AND 45"),
    Check("ck_discount", "lineitem", "l_discount <= 0.05"),
    Check("ck_untaxed_unknown", "lineitem", "nullif(l_tax, 0.0) > 0.01"),
    Check("ck_value_positive", "events", "value > 0"),
    Check("ck_old_rule", "events", "value > 1000", untrusted=True),
    Check("ck_off", "orders", "o_totalprice < 0", disabled=True),
)
CONSTRAINTS = Constraints(
    KEYS, FOREIGN_KEYS, CHECKS,
    {"lineitem": ("l_orderkey", "l_shipdate"), "documents": ("text",)})

# Computed columns of lineitem, rebuilt at the target.
COMPUTED = {
    "net_price": "l_extendedprice * (1 - l_discount)",
    "lead_days": "datediff(l_shipdate, timestamp_ntz'1992-01-01')",
    "line_label": "concat(l_returnflag, '/', l_linestatus)",
}
