"""The models and their wiring.

dims         calendar, dim_pool, dim_block, staged_blocks
facts        fact_price_1d, fact_block, block_cube, fact_network_stats_1d, fact_pool_stats_1d
obts         obt_block, obt_network_stats_1d, obt_pool_stats_1d
marts        Marts (lazily built, shared intermediates), build (materialise), descendants
extensions   epoch_summary (E3), pool_summary (E4), luck_model (E5), rebuild_days (E1)
orders_star  the same operators on the driver's order lines (second star)
catalog      registered queries for the driver, each with DuckDB oracle SQL
"""
