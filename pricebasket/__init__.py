"""pricebasket: a consumer-price basket index built on Spark DataFrames."""
