"""Operations-analytics jobs for supply-chain and finance tables, on Spark DataFrames."""
