"""The same results as plain SQL over the source tables, for checking ``queries.QUERIES`` in another engine.

Written from the tables and rules directly: messages are not decoded here, their defects are CASE expressions.
"""

from __future__ import annotations

import re

ODD = "TIMESTAMP '2002-01-01 00:00:00'"


def half_up(amount: str, count: str) -> str:
    """amount / count rounded half-up to 2 places in whole-number arithmetic (count > 0)."""
    cents = f"CAST(({amount})*100 AS HUGEINT)"
    return (
        f"CAST(CAST(SIGN({cents})*((2*ABS({cents})+({count}))//(2*({count}))) AS DECIMAL(30,0))"
        f"*CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(25,2))"
    )


def percent(part: str, whole: str, kind: str) -> str:
    p, w = f"CAST(({part})*100 AS HUGEINT)", f"CAST(({whole})*100 AS HUGEINT)"
    return (
        f"CAST(CAST(SIGN({p})*((20000*ABS({p})+{w})//(2*{w})) AS DECIMAL(30,0))"
        f"*CAST(0.01 AS DECIMAL(3,2)) AS {kind})"
    )


_STATE = """CASE WHEN o_orderstatus='F' AND o_orderpriority='5-LOW' THEN '已取消' WHEN o_orderstatus='F' THEN '已完成'
 WHEN o_orderstatus='O' AND o_orderpriority='1-URGENT' THEN '待付款' WHEN o_orderstatus='O' THEN '已付款'
 ELSE '已发货' END"""

_VIEWS = {
    "product_all": """SELECT p_partkey k, CAST(p_partkey AS VARCHAR) product_id, p_name, p_brand, p_type,
 CAST(p_size AS VARCHAR) sub_category, CAST(p_retailprice AS DECIMAL(15,2)) price,
 DATE '2024-01-01' + CAST(p_partkey%365 AS INTEGER) AS born FROM part""",
    "product_doc": f"""SELECT product_id, CASE WHEN k%13=0 THEN NULL ELSE p_name END AS name, p_brand AS brand,
 CASE WHEN k%17=1 THEN NULL ELSE p_type END AS category, sub_category,
 CAST(CASE k%10 WHEN 1 THEN -5.01 WHEN 2 THEN 0 WHEN 3 THEN 0 WHEN 4 THEN 2.35 ELSE price END AS DECIMAL(15,2))
  AS price_live,
 CASE k%10 WHEN 1 THEN CAST(-5.01 AS DECIMAL(15,2)) WHEN 2 THEN NULL WHEN 3 THEN CAST(12.5 AS DECIMAL(15,2))
  WHEN 4 THEN CAST(2.35 AS DECIMAL(15,2)) ELSE price END AS price_given,
 CASE WHEN k%5=0 THEN '' ELSE concat(p_brand, ',', p_type) END AS keywords,
 CASE WHEN k%8=4 OR k%4=3 THEN {ODD} ELSE CAST(born AS TIMESTAMP) + INTERVAL '10:30:15' END
  AS created_live,
 CASE WHEN k%8=4 THEN CAST(born AS TIMESTAMP) + INTERVAL '10:30:00' WHEN k%4=3 THEN {ODD}
  WHEN k%4=2 THEN CAST(born AS TIMESTAMP) + INTERVAL '10:30:15.250'
  ELSE CAST(born AS TIMESTAMP) + INTERVAL '10:30:15' END AS created_documented,
 CASE WHEN k%8=4 THEN CAST(born AS VARCHAR) || 'T10:30' WHEN k%4=0 THEN CAST(born AS VARCHAR) || 'T10:30:15'
  WHEN k%4=1 THEN CAST(born AS VARCHAR) || ' 10:30:15' WHEN k%4=2 THEN CAST(born AS VARCHAR) || 'T10:30:15.250'
  ELSE 'n/a' END AS created_text,
 k%3=0 AS is_variant, k FROM product_all WHERE k%97<>5 AND k%50<>49""",
    "product_documented": """SELECT product_id, COALESCE(name,'未知商品') AS name, brand,
 COALESCE(category,'其他') AS category, sub_category,
 CASE WHEN price_given IS NULL OR price_given<0 THEN CAST(0 AS DECIMAL(15,2)) ELSE price_given END AS price,
 '' AS description, '' AS image_url, keywords, created_documented AS created_at, is_variant,
 (price_given IS NULL OR price_given<0 OR name IS NULL OR category IS NULL) AS is_abnormal FROM product_doc""",
    "item": """SELECT CAST(l_orderkey AS VARCHAR) order_id, CAST(l_partkey AS VARCHAR) product_id,
 p_name product_name, p_brand brand, p_type category, CAST(p_size AS VARCHAR) sub_category,
 CAST(p_retailprice AS DECIMAL(15,2)) price, CAST(l_quantity AS INTEGER) quantity,
 CAST(l_extendedprice AS DECIMAL(15,2)) subtotal, l_orderkey, l_linenumber, l_suppkey, l_shipdate
 FROM lineitem JOIN part ON l_partkey=p_partkey""",
    "order_fact": f"""SELECT o_orderkey k, CAST(o_orderkey AS VARCHAR) order_id, c_name buyer_name,
 CAST(c_custkey AS VARCHAR) buyer_phone, concat(c_custkey,'@example.com') buyer_email, r_name province, n_name city,
 c_mktsegment district, {_STATE} order_status, o_orderpriority pay, CAST(o_totalprice AS DECIMAL(15,2)) order_amount,
 o_orderdate created_at FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey
 JOIN region ON n_regionkey=r_regionkey""",
    "order_head": """SELECT order_id, buyer_name, buyer_phone, buyer_email, province, city, district, order_status,
 CASE WHEN order_status<>'已取消' THEN pay END payment_method,
 CASE WHEN order_status<>'已取消' THEN order_amount END payment_amount,
 CASE WHEN order_status IN ('已发货','已完成') THEN 'Carrier ' || province END logistics_company,
 CASE WHEN order_status IN ('已发货','已完成') THEN 'T' || order_id END tracking_number,
 order_amount, CAST(0 AS DECIMAL(15,2)) discount,
 CASE WHEN order_status='已取消' THEN CAST(0 AS DECIMAL(15,2)) ELSE order_amount END actual_amount, created_at
 FROM order_fact""",
    "order_message": """SELECT f.k, f.order_id, COALESCE(n,1) messages
 FROM order_fact f LEFT JOIN (SELECT order_id oid, COUNT(*) n FROM item GROUP BY order_id) c ON f.order_id=c.oid""",
    "order_doc": f"""SELECT f.*, CASE WHEN k%31=8 THEN '待付款' ELSE order_status END state,
 CASE WHEN k%29=6 THEN 0 ELSE COALESCE(n,0) END item_count, k%11<>5 has_address, k%19<>1 has_payment,
 CAST(CASE WHEN k%10=4 THEN order_amount+CAST(0.01 AS DECIMAL(3,2)) ELSE order_amount END AS DECIMAL(15,2)) amount,
 CASE WHEN k%7=2 THEN {ODD} ELSE created_at END placed
 FROM order_fact f LEFT JOIN (SELECT order_id oid, COUNT(*) n FROM item GROUP BY order_id) c ON f.order_id=c.oid
 WHERE k%37<>9 AND k%50<>49""",
    "order_live": f"""SELECT order_id, CASE WHEN k%13=0 THEN '' ELSE buyer_name END buyer_name, buyer_phone, buyer_email,
 CASE WHEN has_address THEN province ELSE '' END province, CASE WHEN has_address THEN city ELSE '' END city,
 CASE WHEN has_address THEN district ELSE '' END district,
 CASE WHEN has_address THEN concat(city,' ',district) ELSE '' END address_detail,
 CASE WHEN has_address THEN '000000' ELSE '' END postal_code,
 CASE WHEN has_address THEN buyer_name ELSE '' END recipient_name,
 CASE WHEN has_address THEN buyer_phone ELSE '' END recipient_phone, state AS order_status,
 CASE WHEN state<>'已取消' AND has_payment THEN pay END payment_method,
 CASE WHEN state<>'已取消' AND has_payment THEN order_amount END payment_amount,
 CASE WHEN state<>'已取消' AND has_payment THEN created_at + INTERVAL 1 HOUR END payment_time,
 CASE WHEN state IN ('已发货','已完成') THEN 'Carrier ' || province END logistics_company,
 CASE WHEN state IN ('已发货','已完成') THEN 'T' || order_id END tracking_number,
 CASE WHEN state IN ('已发货','已完成') THEN created_at + INTERVAL 1 DAY END shipped_at,
 CASE WHEN state IN ('已发货','已完成') THEN CAST(created_at AS DATE) + 4 END estimated_delivery,
 amount AS order_amount, CAST(0 AS DECIMAL(15,2)) discount,
 CASE WHEN state='已取消' THEN CAST(0 AS DECIMAL(15,2)) ELSE order_amount END actual_amount,
 CAST(item_count AS INTEGER) item_count, placed AS created_at, CAST(NULL AS VARCHAR) remark FROM order_doc""",
    "order_doc_raw": """SELECT * REPLACE (CASE WHEN k%31=8 THEN '待付款' WHEN k%3<>0 THEN order_status ELSE CASE order_status
 WHEN '待付款' THEN 'pending' WHEN '已付款' THEN 'paid' WHEN '已发货' THEN 'shipped' WHEN '已完成' THEN 'completed'
 ELSE 'cancelled' END END AS state) FROM order_doc""",
    "item_doc": """SELECT i.order_id, product_id, product_name, brand, category,
 sub_category, price AS original_price, price, quantity, subtotal, o.k FROM item i
 JOIN order_doc o ON i.order_id=o.order_id WHERE o.k%29<>6""",
    "item_order": """SELECT i.*, o.buyer_name, o.buyer_phone, o.buyer_email, o.province, o.city, o.district,
 o.order_status, o.payment_method, o.payment_amount, o.logistics_company, o.tracking_number, o.order_amount,
 o.discount, o.actual_amount, o.created_at, CAST(o.created_at AS DATE) dt
 FROM item i LEFT JOIN order_head o ON i.order_id=o.order_id""",
    "wide": """SELECT order_id, product_id, product_name, brand, category, sub_category, price, quantity, subtotal,
 COALESCE(order_status,'') order_status, COALESCE(buyer_name,'') buyer_name, COALESCE(buyer_phone,'') buyer_phone,
 COALESCE(buyer_email,'') buyer_email, COALESCE(province,'') province, COALESCE(city,'') city,
 COALESCE(district,'') district, COALESCE(payment_method,'') payment_method, COALESCE(payment_amount,0) payment_amount,
 COALESCE(logistics_company,'') logistics_company, COALESCE(tracking_number,'') tracking_number,
 COALESCE(order_amount,0) order_amount, COALESCE(discount,0) discount, COALESCE(actual_amount,0) actual_amount,
 created_at AS order_created_at, dt FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, product_id
  ORDER BY l_linenumber, l_suppkey, subtotal, quantity, l_shipdate) rn FROM item_order) t WHERE rn=1""",
    "product_day": f"""SELECT *, CASE WHEN total_quantity>0 THEN {half_up('total_amount', 'total_quantity')}
 ELSE CAST(0 AS DECIMAL(25,2)) END avg_price FROM (SELECT product_id, dt, MAX(product_name) product_name,
 MAX(category) category, MAX(brand) brand, CAST(SUM(quantity) AS BIGINT) total_quantity,
 CAST(SUM(subtotal) AS DECIMAL(25,2)) total_amount, COUNT(DISTINCT order_id) order_count
 FROM item_order GROUP BY product_id, dt) t""",
    "category_day": """SELECT category, dt, CAST(SUM(quantity) AS BIGINT) total_quantity,
 CAST(SUM(subtotal) AS DECIMAL(25,2)) total_amount, COUNT(DISTINCT order_id) order_count,
 COUNT(DISTINCT product_id) sku_count FROM item_order GROUP BY category, dt""",
    "user_day": """SELECT buyer_phone, dt, MAX(COALESCE(buyer_name,'')) buyer_name, COUNT(DISTINCT order_id) order_count,
 CAST(SUM(COALESCE(actual_amount,subtotal,0)) AS DECIMAL(25,2)) total_amount,
 CAST(SUM(quantity) AS BIGINT) total_quantity,
 CAST(SUM(CASE WHEN order_status='已完成' THEN 1 ELSE 0 END) AS BIGINT) completed_count,
 CAST(SUM(CASE WHEN order_status='已取消' THEN 1 ELSE 0 END) AS BIGINT) cancelled_count,
 CAST(SUM(CASE WHEN order_status IN ('待付款','已付款','已发货') THEN 1 ELSE 0 END) AS BIGINT) pending_count
 FROM item_order WHERE COALESCE(buyer_phone,'')<>'' GROUP BY buyer_phone, dt""",
    "revenue": f"""SELECT t.*, {percent('total_amount', 'grand', 'DECIMAL(5,2)')} percentage,
 RANK() OVER (ORDER BY total_amount DESC) AS "rank" FROM (SELECT category,
 CAST(SUM(total_amount) AS DECIMAL(25,2)) total_amount, CAST(SUM(total_quantity) AS BIGINT) total_quantity,
 CAST(SUM(order_count) AS BIGINT) order_count, CAST(SUM(sku_count) AS BIGINT) sku_count
 FROM category_day GROUP BY category) t CROSS JOIN (SELECT CAST(SUM(total_amount) AS DECIMAL(25,2)) grand
 FROM category_day) g""",
    "trend": f"""SELECT *, {half_up('total_sales_amount', 'total_order_count')} avg_order_amount FROM (SELECT dt,
 CAST(SUM(total_amount) AS DECIMAL(25,2)) total_sales_amount, CAST(SUM(order_count) AS BIGINT) total_order_count
 FROM category_day GROUP BY dt) t""",
    "user_worth": f"""SELECT *, {half_up('total_monetary', 'order_frequency')} avg_order_amount,
 CASE WHEN total_monetary>=12000000 THEN '高价值' WHEN total_monetary>=6000000 THEN '中价值' ELSE '低价值' END value_tier
 FROM (SELECT buyer_phone, MAX(buyer_name) buyer_name, MAX(dt) last_order_date,
 CAST(SUM(order_count) AS BIGINT) order_frequency, CAST(SUM(total_amount) AS DECIMAL(25,2)) total_monetary
 FROM user_day GROUP BY buyer_phone) t""",
    "ranking": """SELECT *, RANK() OVER (ORDER BY total_quantity DESC) AS "rank" FROM (SELECT product_id,
 MAX(product_name) product_name, MAX(category) category, MAX(brand) brand,
 CAST(SUM(total_quantity) AS BIGINT) total_quantity, CAST(SUM(total_amount) AS DECIMAL(25,2)) total_amount
 FROM product_day GROUP BY product_id) t""",
    "regional": f"""SELECT province, city, district, total_orders, total_amount,
 {half_up('total_amount', 'total_orders')} avg_order_amount, buyer_count FROM (SELECT province,
 CASE WHEN GROUPING(city)=1 THEN '合计' ELSE city END city,
 CASE WHEN GROUPING(district)=1 THEN '合计' ELSE district END district, GROUPING(city) gc,
 COUNT(DISTINCT order_id) total_orders, CAST(SUM(actual_amount) AS DECIMAL(25,2)) total_amount,
 COUNT(DISTINCT buyer_phone) buyer_count FROM wide
 GROUP BY GROUPING SETS ((province),(province,city),(province,city,district))) t
 WHERE (gc=1 AND province<>'') OR (gc=0 AND city<>'')""",
    "day_top": """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY last_order_date
 ORDER BY total_monetary DESC, buyer_phone) AS day_rank FROM user_worth) t WHERE day_rank<=10""",
    "goods": """SELECT product_id AS sku_id, product_id, p_name spu_name, concat(p_name,' ',p_brand,' ',p_type) sku_name,
 p_brand brand_name, p_type first_category_name, sub_category second_category_name,
 MIN(price) OVER (PARTITION BY p_name) price_min, MAX(price) OVER (PARTITION BY p_name) price_max, price sku_price,
 CAST(price - MIN(price) OVER (PARTITION BY p_name) AS DECIMAL(15,2)) price_delta,
 concat(p_brand,' ',p_type) variant_suffix, '' image_url, concat(p_brand,',',p_type) keywords, born start_date,
 DATE '9999-12-31' end_date, CASE WHEN k%7=0 THEN 0 ELSE 1 END is_active, CAST(born AS TIMESTAMP) dw_create_time,
 CAST(born AS TIMESTAMP) dw_update_time FROM product_all""",
    "active_goods": "SELECT * FROM goods WHERE is_active=1",
}


def _select(body: str) -> str:
    """``body`` preceded by the views it names, and those they name."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in _VIEWS:
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql) and name not in needed:
                visit(_VIEWS[name])
                needed.append(name)

    visit(body)
    ctes = ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


_VIEWS["order_raw"] = _VIEWS["order_live"].replace("FROM order_doc", "FROM order_doc_raw")

_PROD_COLUMNS = "product_id, name, brand, category, sub_category, price, description, image_url, keywords, created_at, \
is_variant, is_abnormal"
_REPORT_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_suppkey, subtotal, quantity"
_REPORT_PRICE = half_up("subtotal", "quantity")

_GOODS_PAGE = """SELECT sku_id, spu_name, sku_name, brand_name, first_category_name, sku_price, price_min, price_max
 FROM active_goods WHERE first_category_name='PROMO' AND (contains(spu_name,'ring') OR contains(sku_name,'ring'))
 ORDER BY dw_create_time DESC, sku_id LIMIT 10 OFFSET 10"""

_BODIES = {
    "ods_nonempty": """SELECT 'products' AS feed, COUNT(*) AS messages FROM part WHERE p_partkey%97<>5
 UNION ALL SELECT 'orders', CAST(SUM(messages) AS BIGINT) FROM order_message WHERE k%37<>9""",
    "ods_order_decode": """SELECT o.order_id,
 CASE WHEN k%31=8 THEN '' WHEN k%3<>0 THEN order_status ELSE CASE order_status WHEN '待付款' THEN 'pending'
  WHEN '已付款' THEN 'paid' WHEN '已发货' THEN 'shipped' WHEN '已完成' THEN 'completed' ELSE 'cancelled' END END
  AS order_status,
 CASE WHEN item_count>0 THEN CAST(item_count AS INTEGER) END AS items,
 CASE WHEN item_count>0 THEN s END AS subtotal, 99 AS item_count,
 CAST(CASE WHEN k%10=4 THEN order_amount+CAST(0.005 AS DECIMAL(4,3)) ELSE order_amount END AS DECIMAL(18,3))
  AS order_amount,
 CASE WHEN k%13=0 THEN '' ELSE buyer_name END AS buyer_name, CASE WHEN has_address THEN city END AS city,
 CASE WHEN has_payment THEN pay END AS payment_method, 'T' || o.order_id AS tracking_number,
 CASE WHEN k%7=2 THEN 'unknown' ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%S') END AS created_at
 FROM order_doc o LEFT JOIN (SELECT order_id oid, CAST(SUM(subtotal) AS DECIMAL(25,2)) s FROM item GROUP BY order_id) x
 ON o.order_id=x.oid""",
    "ods_product_decode": """SELECT product_id, COALESCE(name,'') AS name, CAST(sub_category AS INTEGER) AS sub_category,
 CASE WHEN k%3=1 THEN 'STRING' ELSE 'BOOLEAN' END AS is_variant_type,
 CASE WHEN k%5=0 THEN NULL ELSE brand END AS first_keyword, created_text AS created_at FROM product_doc""",
    "ods_dead_letter": """SELECT feed, reason, CAST(SUM(messages) AS BIGINT) AS messages FROM (
 SELECT 1 AS messages, 'products' AS feed, CASE WHEN k%50=49 THEN 'malformed_json' WHEN k%13=0 THEN 'missing_name'
  WHEN k%17=1 THEN 'missing_category' END AS reason FROM product_all WHERE k%97<>5
 UNION ALL SELECT messages, 'orders', CASE WHEN f.k%50=49 THEN 'malformed_json' WHEN item_count=0 THEN 'no_items' END
 FROM order_message f LEFT JOIN order_doc d ON f.order_id=d.order_id WHERE f.k%37<>9) t
 WHERE reason IS NOT NULL GROUP BY feed, reason""",
    "ods_typed_rejects": """SELECT CASE WHEN k%50=49 THEN 'malformed_json' WHEN k%3=1 OR k%5=0 THEN 'wrong_type'
 ELSE 'accepted' END AS reason, COUNT(*) AS messages FROM product_all WHERE k%97<>5 GROUP BY 1""",
    "ods_typed_products": """SELECT product_id, COALESCE(name,'') AS name, CAST(CASE k%10 WHEN 1 THEN -5.005 WHEN 2 THEN NULL
 WHEN 3 THEN 12.5 WHEN 4 THEN 2.345 ELSE price_given END AS DECIMAL(18,3)) AS price, sub_category, is_variant,
 created_text AS created_at FROM product_doc WHERE k%3<>1 AND k%5<>0""",
    "ddl_defaults": f"""SELECT product_id, name, category, CAST(0 AS DECIMAL(15,2)) AS price, CAST(NULL AS VARCHAR) AS description,
 {ODD} AS created_at, FALSE AS is_variant, FALSE AS is_abnormal FROM product_doc
 WHERE name IS NOT NULL AND category IS NOT NULL""",
    "ddl_refusals": """SELECT CASE WHEN name IS NULL THEN 'name' ELSE 'category' END AS refused, COUNT(*) AS rows
 FROM product_doc WHERE name IS NULL OR category IS NULL GROUP BY 1""",
    "clean_strings": """SELECT product_id, COALESCE(name,'?') AS name_live, COALESCE(name,'未知商品') AS name_documented,
 COALESCE(category,'') AS category_live, COALESCE(category,'其他') AS category_documented, sub_category,
 'none' AS description FROM product_doc""",
    "clean_money": """SELECT product_id, price_live AS price,
 COALESCE(price_given, CAST(0 AS DECIMAL(15,2))) AS price_from_text FROM product_doc""",
    "clean_ints": """SELECT order_id, product_id, CASE WHEN k%23=4 THEN 1 ELSE quantity END AS quantity, 1 AS sales_volume
 FROM item_doc""",
    "clean_flags": "SELECT product_id, is_variant FROM product_doc",
    "clean_keywords": "SELECT product_id, keywords FROM product_doc",
    "clean_timestamps": "SELECT product_id, created_live, created_documented FROM product_doc",
    "clean_price_repair": "SELECT product_id, price, is_abnormal FROM product_documented",
    "order_flatten": """SELECT order_id, buyer_name, buyer_phone, buyer_email, province, city, district, address_detail,
 postal_code, recipient_name, recipient_phone FROM order_live""",
    "order_status_rules": """SELECT order_id, order_status, payment_method, payment_amount, payment_time,
 logistics_company, tracking_number, shipped_at, estimated_delivery, actual_amount FROM order_live""",
    "order_item_count": "SELECT order_id, item_count FROM order_live",
    "order_status_map": "SELECT order_id, state AS order_state FROM order_doc",
    "dwd_product": f"SELECT {_PROD_COLUMNS} FROM product_documented",
    "dwd_product_live": """SELECT product_id, COALESCE(name,'?') AS name, brand, COALESCE(category,'') AS category,
 sub_category, price_live AS price, '' AS description, '' AS image_url, keywords, created_live AS created_at,
 is_variant, FALSE AS is_abnormal FROM product_doc""",
    "dwd_order": "SELECT * FROM order_live",
    "dwd_order_live": "SELECT * REPLACE (CAST(NULL AS DATE) AS estimated_delivery) FROM order_raw",
    "dwd_order_item": """SELECT order_id, product_id, product_name, brand, category, sub_category,
 original_price, price, CASE WHEN k%23=4 THEN 1 ELSE quantity END AS quantity, 1 AS sales_volume, subtotal
 FROM item_doc""",
    "dwd_order_item_documented": """SELECT order_id, product_id, product_name, brand, category, sub_category,
 original_price, price, CASE WHEN k%23=4 THEN 1 ELSE quantity END AS quantity,
 CASE WHEN k%23=4 THEN quantity ELSE 1 END AS sales_volume, subtotal FROM item_doc""",
    "dwd_order_nonempty": "SELECT order_id, order_status, item_count FROM order_live WHERE item_count>0",
    "upsert_partial_product": f"""SELECT a.product_id, a.category, z.name, z.price FROM
 (SELECT product_id, category || ' ' || CAST(l_suppkey AS VARCHAR) AS category,
  ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY {_REPORT_ORDER}) AS n FROM item) a JOIN
 (SELECT product_id, product_name || ' ' || CAST(l_suppkey AS VARCHAR) AS name,
  CAST({_REPORT_PRICE} AS DECIMAL(15,2)) AS price, ROW_NUMBER() OVER (PARTITION BY product_id
  ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, subtotal DESC, quantity DESC) AS n
  FROM item) z ON a.product_id=z.product_id WHERE a.n=1 AND z.n=1""",
    "upsert_partial_order": """SELECT order_id, CAST(NULL AS VARCHAR) AS payment_method, order_amount, order_status,
 actual_amount FROM order_head""",
    "append_items_idempotent": """SELECT i.order_id, product_id, quantity, subtotal,
 CASE WHEN order_status IN ('已完成','已取消') THEN 'stored' ELSE 'added' END AS origin
 FROM item i JOIN order_head o ON i.order_id=o.order_id""",
    "append_parts_idempotent": """SELECT DISTINCT i.order_id, CAST(l_linenumber AS VARCHAR) AS part, TRUE AS fits,
 order_status='已完成' AS known FROM item i JOIN order_head o ON i.order_id=o.order_id
 UNION ALL SELECT DISTINCT i.order_id, '', FALSE, FALSE FROM item i JOIN order_head o ON i.order_id=o.order_id
 WHERE order_status='已取消'""",
    "upsert_metrics": """SELECT COALESCE(n.product_id,o.product_id) AS product_id, COALESCE(n.dt,o.dt) AS dt,
 CASE WHEN o.product_id IS NOT NULL THEN 'stored ' || o.product_name ELSE n.product_name END AS product_name,
 COALESCE(o.category,n.category) AS category, COALESCE(o.brand,n.brand) AS brand,
 COALESCE(n.total_quantity,o.total_quantity) AS total_quantity,
 COALESCE(n.total_amount,o.total_amount) AS total_amount, COALESCE(n.order_count,o.order_count) AS order_count,
 COALESCE(n.avg_price,o.avg_price) AS avg_price FROM (SELECT * FROM product_day WHERE dt<DATE '1999-01-01') o
 FULL JOIN (SELECT * FROM product_day WHERE dt>=DATE '1998-01-01') n ON o.product_id=n.product_id AND o.dt=n.dt""",
    "join_item_order": """SELECT order_id, product_id, quantity, subtotal, order_status, buyer_phone, actual_amount, dt
 FROM item_order""",
    "join_wide_product": """SELECT order_id, i.product_id, COALESCE(p.name,i.product_name) AS product_name,
 COALESCE(p.brand,i.brand) AS brand, COALESCE(p.category,i.category) AS category,
 COALESCE(p.sub_category,i.sub_category) AS sub_category, quantity, subtotal
 FROM item i LEFT JOIN product_documented p ON i.product_id=p.product_id""",
    "join_orphan_defaults": f"""SELECT i.order_id, product_id, subtotal, COALESCE(order_status,'') AS order_status,
 COALESCE(buyer_phone,'') AS buyer_phone, COALESCE(province,'') AS province, COALESCE(order_amount,0) AS order_amount,
 COALESCE(actual_amount,0) AS actual_amount, CAST(COALESCE(created_at,{ODD}) AS DATE) AS dt
 FROM item i LEFT JOIN (SELECT * FROM order_head WHERE order_status<>'已发货') o ON i.order_id=o.order_id""",
    "dws_order_wide": "SELECT * FROM wide",
    "dws_product_sales_1d": "SELECT * FROM product_day",
    "dws_category_sales_1d": "SELECT * FROM category_day",
    "dws_user_order_1d": "SELECT * FROM user_day",
    "dws_user_order_1d_order_grain": """SELECT buyer_phone, CAST(created_at AS DATE) AS dt, MAX(buyer_name) AS buyer_name,
 COUNT(*) AS order_count, CAST(SUM(actual_amount) AS DECIMAL(25,2)) AS total_amount,
 CAST(SUM(q) AS BIGINT) AS total_quantity,
 CAST(SUM(CASE WHEN order_status='已完成' THEN 1 ELSE 0 END) AS BIGINT) AS completed_count,
 CAST(SUM(CASE WHEN order_status='已取消' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled_count,
 CAST(SUM(CASE WHEN order_status IN ('待付款','已付款','已发货') THEN 1 ELSE 0 END) AS BIGINT) AS pending_count
 FROM order_head o JOIN (SELECT order_id oid, SUM(quantity) q FROM item GROUP BY order_id) x ON o.order_id=x.oid
 GROUP BY buyer_phone, CAST(created_at AS DATE)""",
    "ads_category_revenue": "SELECT * FROM revenue",
    "ads_category_revenue_dense": 'SELECT *, DENSE_RANK() OVER (ORDER BY total_amount DESC) AS dense_rank FROM revenue',
    "ads_category_revenue_exact": f"""SELECT t.*, {percent('total_amount', 'grand', 'DECIMAL(5,2)')} AS percentage,
 RANK() OVER (ORDER BY total_amount DESC) AS "rank" FROM (SELECT category,
 CAST(SUM(subtotal) AS DECIMAL(25,2)) total_amount, CAST(SUM(quantity) AS BIGINT) total_quantity,
 COUNT(DISTINCT order_id) order_count, COUNT(DISTINCT product_id) sku_count FROM item GROUP BY category) t
 CROSS JOIN (SELECT CAST(SUM(subtotal) AS DECIMAL(25,2)) grand FROM item) g""",
    "ads_daily_sales_trend": "SELECT * FROM trend",
    "ads_daily_sales_trend_exact": f"""SELECT *, {half_up('total_sales_amount', 'total_order_count')} AS avg_order_amount
 FROM (SELECT dt, CAST(SUM(subtotal) AS DECIMAL(25,2)) total_sales_amount, COUNT(DISTINCT order_id) total_order_count
 FROM item_order GROUP BY dt) t""",
    "ads_daily_trend_change": f"""SELECT *,
 {percent('amount_change', 'previous_amount', 'DECIMAL(25,2)')} AS change_percent FROM (SELECT *,
 CAST(total_sales_amount-previous_amount AS DECIMAL(25,2)) AS amount_change FROM (SELECT dt, total_sales_amount,
 LAG(dt) OVER (ORDER BY dt) AS previous_dt, LAG(total_sales_amount) OVER (ORDER BY dt) AS previous_amount
 FROM trend) a) b""",
    "ads_user_value": "SELECT * FROM user_worth",
    "ads_product_ranking": "SELECT * FROM ranking",
    "ads_regional_province": "SELECT * FROM regional WHERE city='合计'",
    "ads_regional_city": "SELECT * FROM regional WHERE city<>'合计' AND district='合计'",
    "ads_regional_sales": "SELECT * FROM regional",
    "ads_regional_sales_order_grain": f"""SELECT province, city, district, total_orders, total_amount,
 {half_up('total_amount', 'total_orders')} AS avg_order_amount, buyer_count FROM (SELECT province,
 CASE WHEN GROUPING(city)=1 THEN '合计' ELSE city END city,
 CASE WHEN GROUPING(district)=1 THEN '合计' ELSE district END district,
 COUNT(DISTINCT order_id) total_orders, CAST(SUM(actual_amount) AS DECIMAL(25,2)) total_amount,
 COUNT(DISTINCT buyer_phone) buyer_count
 FROM (SELECT DISTINCT order_id, buyer_phone, province, city, district, actual_amount FROM wide) d
 GROUP BY GROUPING SETS ((province),(province,city),(province,city,district))) t""",
    "q_category_revenue": 'SELECT * FROM revenue ORDER BY "rank", category',
    "q_daily_trend_all": "SELECT * FROM trend ORDER BY dt",
    "q_daily_trend": "SELECT * FROM trend WHERE dt BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' ORDER BY dt",
    "q_user_value": "SELECT * FROM user_worth WHERE value_tier='中价值' ORDER BY total_monetary DESC, buyer_phone",
    "q_tier_distribution": "SELECT value_tier, COUNT(*) AS user_count FROM user_worth GROUP BY value_tier",
    "q_product_ranking": """SELECT * FROM ranking WHERE category='MEDIUM' ORDER BY "rank", product_id LIMIT 20""",
    "q_regional_sales": """SELECT * FROM regional WHERE city<>'合计' AND district='合计'
 ORDER BY total_amount DESC, province, city""",
    "q_dashboard_kpi": """SELECT (SELECT CAST(SUM(total_sales_amount) AS DECIMAL(25,2)) FROM trend) AS total_sales_amount,
 (SELECT CAST(SUM(total_order_count) AS BIGINT) FROM trend) AS total_order_count,
 (SELECT COUNT(*) FROM user_worth) AS active_user_count, (SELECT COUNT(*) FROM ranking) AS active_sku_count""",
    "q_goods_page": _GOODS_PAGE,
    "q_goods_page_sought": _GOODS_PAGE,
    "q_goods_page_after": _GOODS_PAGE,
    "q_goods_count": """SELECT COUNT(*) AS total FROM active_goods WHERE first_category_name='PROMO'
 AND (contains(spu_name,'ring') OR contains(sku_name,'ring'))""",
    "q_goods_categories": "SELECT DISTINCT first_category_name FROM active_goods ORDER BY 1",
    "q_goods_brands": "SELECT DISTINCT brand_name FROM active_goods ORDER BY 1",
    "v_recent_trend": "SELECT * FROM trend WHERE dt BETWEEN DATE '2001-08-01' - 90 AND DATE '2001-08-01' ORDER BY dt",
    "v_daily_top_users": "SELECT * FROM day_top",
    "v_top_users_by_tier": """SELECT value_tier, COUNT(*) AS user_count,
 CAST(SUM(total_monetary) AS DECIMAL(25,2)) AS total_monetary FROM day_top GROUP BY value_tier""",
    "v_top_regions": """SELECT *, ROW_NUMBER() OVER (ORDER BY total_amount DESC, province, city, district) AS row_no
 FROM regional WHERE city<>'合计' AND district='合计' ORDER BY row_no LIMIT 10""",
    "v_top_high_value": """SELECT *, ROW_NUMBER() OVER (ORDER BY total_monetary DESC, buyer_phone) AS row_no
 FROM user_worth WHERE value_tier='高价值' ORDER BY row_no LIMIT 20""",
    "v_goods_pages": """SELECT COUNT(*) AS total, CAST(GREATEST(CEIL(COUNT(*)/15.0),1) AS BIGINT) AS pages
 FROM active_goods""",
    "v_user_recency": """SELECT buyer_phone, CAST(DATE '2001-08-01' - last_order_date AS INTEGER) AS recency_days,
 order_frequency, total_monetary FROM user_worth""",
    "v_home_top5": """SELECT * FROM (SELECT 'category' AS list, category AS name, "rank", total_amount, total_quantity
 FROM revenue ORDER BY "rank", category LIMIT 5) a UNION ALL SELECT * FROM (SELECT 'product', product_id, "rank",
 total_amount, total_quantity FROM ranking ORDER BY "rank", product_id LIMIT 5) b""",
    "dq_wide_vs_items": """SELECT w AS wide_rows, i AS item_rows, i-w AS missing_rows
 FROM (SELECT (SELECT COUNT(*) FROM wide) w, (SELECT COUNT(*) FROM item) i) t""",
    "dq_ratios": """SELECT 'avg_price' AS "check", COUNT(*) AS checked, COUNT(*) FILTER (WHERE NOT COALESCE(
 ABS(2*(avg_price*total_quantity-total_amount))<=total_quantity*0.01, FALSE)) AS violations FROM product_day
 UNION ALL SELECT 'avg_order_amount', COUNT(*), COUNT(*) FILTER (WHERE NOT COALESCE(
 ABS(2*(avg_order_amount*total_order_count-total_sales_amount))<=total_order_count*0.01, FALSE)) FROM trend""",
    "dq_share_rank": """SELECT COUNT(*) AS categories, CAST(SUM(percentage) AS DECIMAL(15,2)) AS percentage_sum,
 MIN("rank") AS first_rank, MAX("rank") AS last_rank, COUNT(*)-COUNT(DISTINCT "rank") AS tied_rows FROM revenue""",
    "dq_tiers": """SELECT 'value_tier' AS "check", COUNT(*) AS checked, SUM(CASE
 WHEN (total_monetary>=12000000)<>(value_tier='高价值') OR (total_monetary<6000000)<>(value_tier='低价值')
 THEN 1 ELSE 0 END)::BIGINT AS violations FROM user_worth""",
    "dq_required_fields": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE COALESCE({c},'')='') AS blank_rows FROM wide"
        for c in ("buyer_name", "province", "city", "category", "payment_method", "logistics_company")
    ),
    "dq_region_rollup": """SELECT 'province_amount' AS "check", COUNT(*) AS checked,
 COUNT(*) FILTER (WHERE p.total_amount IS DISTINCT FROM c.a) AS violations
 FROM (SELECT province, SUM(actual_amount) total_amount FROM wide GROUP BY province) p
 FULL JOIN (SELECT province, SUM(total_amount) a FROM regional WHERE city<>'合计' AND district='合计'
 GROUP BY province) c ON p.province=c.province""",
    "dq_sku_count": """SELECT 'sku_count' AS "check", COUNT(*) AS checked,
 COUNT(*) FILTER (WHERE d.sku_count IS DISTINCT FROM t.n) AS violations FROM category_day d
 FULL JOIN (SELECT category, dt, COUNT(*) n FROM (SELECT DISTINCT category, dt, product_id FROM item_order) u
 GROUP BY category, dt) t ON d.category=t.category AND d.dt=t.dt""",
    "dq_user_trace": """SELECT COUNT(*) AS buyer_days, COUNT(*) FILTER (WHERE d.buyer_phone IS NULL) AS without_orders,
 COUNT(*) FILTER (WHERE u.buyer_phone IS NULL) AS without_summary FROM user_day u
 FULL JOIN (SELECT DISTINCT buyer_phone, CAST(created_at AS DATE) dt FROM order_head
 WHERE order_id IN (SELECT order_id FROM item)) d ON u.buyer_phone=d.buyer_phone AND u.dt=d.dt""",
    "dim_goods_info": "SELECT * FROM goods",
    "event_daily_windows": """SELECT CAST(ts AS DATE) AS dt, event_type, COUNT(*) AS events,
 CAST(SUM(CAST(value AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS total FROM events GROUP BY 1, 2""",
    "event_without_repeats": "SELECT event_id, user_id, event_type FROM events",
    "event_pairs_once": "SELECT DISTINCT user_id, event_type FROM events",
    "ads_category_revenue_kept": "SELECT * FROM revenue",
    "ads_product_ranking_kept": "SELECT * FROM ranking",
    "ads_user_value_kept": "SELECT * FROM user_worth",
    "ads_regional_sales_kept": "SELECT * FROM regional",
    "stream_category_totals": "SELECT category, dt, total_quantity, total_amount FROM category_day",
    "dim_goods_history": """SELECT product_id AS sku_id, product_name AS spu_name, category AS first_category_name,
 MIN(price) OVER (PARTITION BY product_name) AS price_min, MAX(price) OVER (PARTITION BY product_name) AS price_max,
 price AS sku_price, CAST(price-MIN(price) OVER (PARTITION BY product_name) AS DECIMAL(15,2)) AS price_delta,
 day AS start_date, COALESCE(LEAD(day) OVER (PARTITION BY product_id ORDER BY day) - 1, DATE '9999-12-31') AS end_date,
 CASE WHEN LEAD(day) OVER (PARTITION BY product_id ORDER BY day) IS NULL THEN 1 ELSE 0 END AS is_active FROM (
 SELECT *, LAG(price) OVER (PARTITION BY product_id ORDER BY day) AS was FROM (
 SELECT product_id, product_name, category, CAST(l_shipdate AS DATE) AS day,
 CAST(FLOOR(subtotal/10000)*10000 AS DECIMAL(15,2)) AS price, ROW_NUMBER() OVER (PARTITION BY product_id,
  CAST(l_shipdate AS DATE) ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, subtotal DESC,
  quantity DESC) AS n FROM item) r WHERE n=1) v WHERE was IS DISTINCT FROM price""",
}

ORACLES: dict[str, str] = {name: _select(body) for name, body in _BODIES.items()}
