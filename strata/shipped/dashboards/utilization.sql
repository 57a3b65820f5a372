select age_band, sex, care_setting_key, n encounter_count, avg_los_days from gold_mart_utilization order by age_band, sex, care_setting_key
