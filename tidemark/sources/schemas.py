"""Fixed schemas of the input tables (DDL strings)."""

SCREEN_EVENT = """p_date date, time_stamp bigint, devicename string, traceid string, contentid string, adsn string,
 tag string, event string, category string, page string, targetvalue string, currentvalue string, message string,
 env string, versioncode string, playtime double, utmsource string, utmcampaign string, utmcontent string"""
DEVICE_SERVICE = "third_code string, car_id bigint, status int, is_delete int, tag string, add_time timestamp_ntz"
SCREEN_INFO = "device_name string, owner_sn string, main_app string, desc string"
SCREEN_CAR = "id bigint, city_sn int, car_type string"
DEVICE_SNAPSHOT = "p_date date, devicename string, city_sn int"
TRIP = "device_name string, add_time timestamp_ntz"
HEARTBEAT = "sn string, day date"
SENSOR_SUMMARY = "sn string, day date, tag string"
ABNORMAL_DEVICE = "device_name string, day date"
CALENDAR = "day date"
EXCLUDED_DEVICE = "devicename string"
CAMPAIGN_RULE = """priority int, utm_source string, utm_campaign string, content_match string, match_kind string,
 target string"""
SHOP_ORDER = """id bigint, order_sn string, coupon_seq string, driver_id bigint, driver_tel string, user_id bigint,
 user_tel string, price bigint, discount_amount bigint, pay_amount bigint, num bigint, status int, pay_type int,
 pay_order_sn string, is_first int, add_time timestamp_ntz, update_time timestamp_ntz"""
ORDER_LINE = """id bigint, order_sn string, driver_id bigint, driver_tel string, user_tel string, box_sn string,
 sku_id bigint, price bigint, status int, add_time timestamp_ntz, update_time timestamp_ntz"""
DRIVER = "id bigint, is_checked int, shelf_sn string, checked_time timestamp_ntz"
DRIVER_INFO = "driver_id bigint, distric_sn int, leasing_company_sn string"
DRIVER_TAG = "driver_id bigint, work_type int, stock_warming int"
DRIVER_SHELF = "driver_id bigint, shelf_sn string"
USER_TAG = "mobile string, driver_tag string"
CITY = "distric_sn int, city_sn int"
COMPANY = "leasing_company_sn string, city_name string, leasing_company_abbreviation string, is_deleted int"
SKU = "id bigint, name string, content string, img string"
SKU_GOODS = "sku_id bigint, goods_purchase_price bigint, goods_num bigint, is_deleted int"
ORDER_COMMENT = """order_sn string, appraise int, tag_id string, comment string, add_time timestamp_ntz,
 update_time timestamp_ntz"""
COMMENT_TAG = "id int, tag string"
SCAN_LOG = "module string, user_tel string, user_id string, shelf_sn string, driver_id bigint, add_time timestamp_ntz"
REPLENISHMENT = "driver_id bigint, rep_sn string, rep_type int, add_time timestamp_ntz"
ESTIMATE = "rep_sn string, level int, add_time timestamp_ntz"
