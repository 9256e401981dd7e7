"""filmlake: bronze, silver and gold layers for catalogue data, as Spark DataFrames."""
