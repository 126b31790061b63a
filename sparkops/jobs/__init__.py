"""End-to-end jobs, one function each: ``job(spark, *paths, **params)``.

J01 videos, J02 restaurants, J03 movies, J04 bike_projection,
J05 bike_workday, J06 bike_min_max, J07 mall_income, J08 season_word_ranks
(frames); J09 shoes, J10/J11 job_reviews, J12 cars, J13 positions,
J14 pizza (records); J15 avocado, J16 access_log, J17 products (lines);
J18 salary_by_department, J19 join_layouts, J20 freelancer_offers,
J21 hotel_cancellations, J22/J23 basket (tuning).
"""

from sparkops.jobs.frames import (  # noqa: F401
    bike_min_max, bike_projection, bike_workday, mall_income, movies, restaurants,
    season_word_ranks, videos,
)
from sparkops.jobs.lines import access_log, avocado, products  # noqa: F401
from sparkops.jobs.records import cars, job_reviews, pizza, positions, shoes  # noqa: F401
from sparkops.jobs.tuning import (  # noqa: F401
    basket, freelancer_offers, hotel_cancellations, join_layouts, salary_by_department,
)
