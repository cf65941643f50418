from pyspark.sql import SparkSession


def session():
    spark = (SparkSession.builder.master("local[8]").appName("ferrolite-tests")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call site is looked up for each column
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
