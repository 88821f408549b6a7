"""Values the results depend on, as the original jobs fix them."""

# Fixed values (they must equal the original's for equal results):
# the three cities Beijing, Shanghai, Guangzhou; the category keyword "hot pot";
# the popularity weights and rating scale; the number of shops reported;
# the characters of a time stamp kept as its day (yyyy-MM-dd); and the field
# counts a shop line and a log line need.
DEFAULT_CITIES = ("北京", "上海", "广州")
DEFAULT_KEYWORD = "火锅"
SCORE_WEIGHT = 0.7
ACTIVITY_WEIGHT = 0.3
SCORE_SCALE = 5
DEFAULT_K = 10
DAY_LENGTH = 10
SHOP_REQUIRED_FIELDS = 9
LOG_REQUIRED_FIELDS = 3
