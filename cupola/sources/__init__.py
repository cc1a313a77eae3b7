from cupola.sources.tables import COUPON_SCHEMA, TABLES, coupon_view, read_coupons, read_table

__all__ = ["COUPON_SCHEMA", "TABLES", "coupon_view", "read_coupons", "read_table"]
