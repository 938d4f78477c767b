"""Values that results depend on.

Fixed values: every table, threshold, format and duration below is part of the
defined behaviour of a report, so it is stated literally and in its natural order.
"""

# Share of a course completed -> score. Every bound is exclusive.
COMPLETION_BANDS = ((0.9, 10), (0.5, 4), (0.25, 2))
COMPLETION_FLOOR = 0

# A course view stands for this many seconds watched.
SECONDS_PER_VIEW = 5

# Event-time windows of the live reports.
TUMBLING_WINDOW = "2 minutes"
LATENESS = "10 minutes"
SLIDING_WINDOW = "60 minutes"
SLIDE = "1 minute"
BATCH_INTERVAL = "1 second"
RANKED_ROWS = 50

# Pass rule of the exam report.
STRICT_SUBJECT = "Biology"
STRICT_GRADES = ("A",)
PASSING_GRADES = ("A", "B", "C")

TOP_WORDS = 10

MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# Country groups of the free-trial report.
KEPT_COUNTRIES = ("GB", "US", "UA", "UNKNOWN")
EUROPEAN_COUNTRIES = (
    "BE", "BG", "CZ", "DK", "DE", "EE", "IE", "EL", "ES", "FR", "HR", "IT",
    "CY", "LV", "LT", "LU", "HU", "MT", "NL", "AT", "PL", "PT", "RO", "SI",
    "SK", "FI", "SE", "CH", "IS", "NO", "LI", "EU",
)

# Course names by the key carried in a view record.
COURSE_NAMES = {
    0: "Spring Boot Microservices",
    1: "Spring Framework Fundamentals",
    2: "Spring JavaConfig",
    3: "Spring MVC and WebFlow",
    4: "JavaEE and WildFly Module 1 : Getting Started",
    5: "Hibernate and JPA",
    6: "Java Web Development Second Edition: Module 1",
    7: "Java Fundamentals",
    8: "NoSQL Databases",
    9: "Java Advanced Topics",
    10: "Docker for Java Developers",
    11: "Java Web Development Second Edition: Module 2",
    12: "HTML5 and Responsive CSS for Developers",
    13: "Git",
    14: "Spring Boot",
    15: "Groovy Programming",
    16: "Java Build Tools",
    17: "Hadoop for Java Developers",
    18: "Cloud Deployment with AWS",
    19: "Docker Module 2 for Java Developers",
    20: "Going Further with Android",
    21: "Test Driven Development",
    22: "Introduction to Android",
    23: "Java Web Development",
    24: "Spring Security Module 3",
    25: "Java Messaging with JMS and MDB",
    26: "Spring Remoting and Webservices",
    27: "Thymeleaf",
    28: "Spring Security Module 2: OAuth2 and REST",
    29: "JavaEE and WildFly Module 2: Webservices",
    30: "Spring Security Core Concepts",
    31: "JavaEE and Wildfly Module 3: Messaging",
    32: "JavaEE",
    33: "Microservice Deployment",
    34: "Securing a VPC",
    35: "WTP Plugins for Eclipse",
    36: "Spark for Java Developers",
    37: "JavaEE and Wildfly Module 4: JSF",
    38: "Kubernetes Microservices Module 1",
    39: "Kotlin with Spring Boot",
    40: "Kubernetes Microservices Module 2",
    41: "Spark Module 2 SparkSQL and DataFrames",
    42: "Spark Module 3 Machine Learning SparkML",
}

# Model settings.
HOUSE_REG_PARAMS = (0.01, 0.1, 0.5)
CHURN_REG_PARAMS = (0.01, 0.1, 0.3, 0.5, 0.7, 1.0)
ELASTIC_NET_PARAMS = (0.0, 0.5, 1.0)
HOUSE_TRAIN_SHARE = 0.8
CHURN_TRAIN_SHARE = 0.9
TRIAL_TRAIN_SHARE = 0.8
TREE_DEPTH = 3
CLUSTER_COUNTS = (2, 3, 4, 5, 6, 7, 8)
ALS_ITERATIONS = 10
ALS_REG_PARAM = 0.1
RECOMMENDED_ITEMS = 5
RATING_SCALE = 100

# Columns of the model reports, by the names that their inputs have.
GYM_COLUMNS = ("Age", "Height", "Weight", "Gender")
GYM_CLUSTER_COLUMNS = ("Gender", "Age", "Height", "Weight", "NoOfReps")
HOUSE_COLUMNS = (
    "bedrooms", "bathrooms", "sqft_living", "sqft_above_percentage", "floors",
    "condition", "grade", "zipcode", "waterfront",
)
HOUSE_CATEGORIES = ("condition", "grade", "zipcode")
NOT_CORRELATED = (
    "id", "date", "waterfront", "view", "condition", "grade", "yr_renovated", "zipcode", "lat", "long",
    "sqft_lot", "sqft_lot15", "yr_built", "sqft_living15",
)
CHURN_CATEGORIES = ("payment_method_type", "country", "rebill_period_in_months")
CHURN_COLUMNS = (*CHURN_CATEGORIES, "firstSub", "age", "all_time_views", "last_month_views")
COUNTED_COLUMNS = ("firstSub", "all_time_views", "last_month_views")
TRIAL_COLUMNS = ("rebill_period", "chapter_access_count", "seconds_watched")
