"""Parameters and literals of the original jobs, kept equal so
the jobs give the same answers. Listed in job order."""

# J04 bike projection: rows shown
BIKE_ROWS = 3
# J05 bike workday: not a workday when HOLIDAY is this and FUNCTIONING_DAY is that
BIKE_HOLIDAY = "Holiday"
BIKE_NOT_FUNCTIONING = "No"
# J07 mall income: age shift, inclusive age band after the shift, code-1 gender
MALL_AGE_SHIFT = 2
MALL_AGE_LOW = 30
MALL_AGE_HIGH = 35
MALL_CODE_ONE_GENDER = "Male"
# J08 word ranks: highest rank id (inclusive)
WORD_RANK_LIMIT = 20
# J09 shoes: text fill, default rating, default buyer gender
SHOES_FILL = "n/a"
SHOES_RATING_DEFAULT = 0
SHOES_GENDER_DEFAULT = "unknown"
# J13 positions: title prefixes (compared ignoring case)
POSITION_PREFIXES = ("BI", "it")
# J15 avocado: sales after this ISO date
AVOCADO_AFTER = "2018-02-11"
# J16 access log: response code of the weekday report, top-k size
LOG_STATUS = "404"
LOG_TOP = 3
# J20 freelancer offers: level band
OFFER_LEVEL_BAND = 1
# J21 hotel cancellations: canceled status, cancel code flag
HOTEL_CANCELED = "Canceled"
CODE_CANCELLED = "yes"
# J22/J23 basket: country, day, decimal scale of items per transaction
BASKET_COUNTRY = "United Kingdom"
BASKET_DATE = "2018-12-01"
BASKET_SCALE = 1

# Input contracts: columns and types of the jobs' files, in file order.
# J01 local video records
VIDEO_COLUMNS = ("videoId", "publishedAt", "channelId", "trendingDate")
# J02 restaurants (JSON)
RESTAURANT_SCHEMA = (
    "average_cost_for_two BIGINT, cuisines STRING, deeplink STRING, has_online_delivery INT, "
    "is_delivering_now INT, menu_url STRING, name STRING, url STRING, "
    "user_rating STRUCT<aggregate_rating: STRING, rating_color: STRING, rating_text: STRING, votes: STRING>")
# J03 movies
MOVIES_SCHEMA = (
    "_c0 INT, show_id STRING, type STRING, title STRING, director STRING, cast STRING, "
    "country STRING, date_added DATE, release_year INT, rating STRING, duration INT, "
    "listed_in STRING, description STRING, year_added INT, month_added STRING, season_count INT")
# J09 shoes
SHOES_SCHEMA = ("item_category STRING, item_name STRING, item_after_discount STRING, item_price STRING, "
                "percentage_solds INT, item_rating INT, item_shipping STRING, buyer_gender STRING")
# J10/J11 job reviews
JOB_REVIEWS_SCHEMA = "JobTitle STRING, Company STRING, Location STRING, CompanyReviews STRING, Link STRING"
# J12 cars
CAR_SCHEMA = ("id INT, price INT, brand STRING, types STRING, mileage DOUBLE, color STRING, "
              "date_of_purchase STRING")
# J13 positions
POSITION_SCHEMA = "PositionID INT, Position STRING"
# J14 pizza
PIZZA_SCHEMA = "order_type STRING, address_id INT"
# J15 avocado
AVOCADO_SCHEMA = ("id INT, date STRING, avgPrice DOUBLE, volume DOUBLE, "
                  + ", ".join(f"_c{i} STRING" for i in range(4, 12))
                  + ", year STRING, region STRING")
# J16 access log
LOG_SCHEMA = ("id BIGINT, host STRING, time BIGINT, method STRING, url STRING, "
              "response STRING, bytes BIGINT")
# J17 products, and what a missing field is
PRODUCT_SCHEMA = ("uniq_id STRING, product_name STRING, manufacturer STRING, price STRING, "
                  "number_available STRING, number_of_reviews INT")
PRODUCT_DEFAULTS = {"uniq_id": "", "product_name": "", "manufacturer": "", "price": "",
                    "number_available": "", "number_of_reviews": 0}
