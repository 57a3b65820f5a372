select instrument_key, wave, count(*) n_responses, cast(sum(cast(total_score as decimal(18,4))) as double) / count(*) mean_score,
  cast(sum(cast(change as decimal(18,4))) as double) / count(change) mean_change
from gold_mart_prom_trajectory group by instrument_key, wave having count(*) >= 11 order by 1, 2
