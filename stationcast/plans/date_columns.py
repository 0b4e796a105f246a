"""DATE output columns of catalogue queries (generated by tools/date_columns.py)."""

DATE_COLUMNS = {
    'a10_coverage': ['first_date', 'last_date'],
    'a10_irregular_dates': ['date'],
    'a13_exceedance': ['date'],
    'a13_exceedance_below': ['date'],
    'a13_exceedance_stream': ['date'],
    'a15_risk_days': ['date'],
    'a19_scale_bias': ['date'],
    'a1_daily_agg': ['date'],
    'a1_daily_agg_stream': ['date'],
    'a23_time_range': ['start', 'end'],
    'a24_producer_matrix': ['date'],
    'a2_daily_wind': ['date'],
    'a6_climatology_for_year': ['date'],
    'a8_fill_future': ['date'],
    'a9_delta_change': ['date'],
    'f1_station_daily': ['utctime'],
    'f2_reanalysis_table': ['date'],
    'f4_scenario_tables': ['date'],
    'j11_align_series': ['date'],
    'j13_attach_observed': ['date'],
    'j1_assemble': ['date'],
    'j2_join_obs': ['date'],
    'j3_outer_merge': ['date'],
    'j4_with_stats': ['date'],
    'j5_common_dates': ['date'],
    'j6_missing_dates': ['date'],
    'm1_split_years': ['date'],
    'w6_poly_correction': ['date'],
    'o2_time_sort': ['date'],
    'p10_select_contains': ['date'],
    'p11_select_delimited': ['date'],
    'p12_rename_order': ['utctime'],
    'p13_complete_cases': ['date'],
    'p17_point_mean': ['date'],
    'p18_ensemble_mean': ['date'],
    'p1_date_parts': ['utctime'],
    'p23_align_features': ['date'],
    'p25_stamp': ['date'],
    'p2_clip_period': ['date'],
    'p9_mean_two_times': ['date'],
    'r10_zip_time': ['day', 'time'],
    'r11_rebuild_noleap': ['time'],
    'r13_limit_points': ['date'],
    'r2_pivot_points': ['date'],
    'r4_attach_coords': ['date'],
    'r5_melt': ['date'],
    'r7_reindex_daily': ['date'],
    'r9_repair_360_day': ['date'],
    'r9_repair_360_day_compat': ['date'],
    's10_write_keyed': ['date'],
    's11_union_chunks': ['date'],
    's13_splice_runs': ['date'],
    's1_read_table': ['l_shipdate'],
    's2_trimmed_csv': ['date'],
    's2_trimmed_csv_pattern': ['date'],
    's3_station_blend': ['date'],
    's7_site_dim': ['date', 'start', 'end'],
    's9_read_keyed': ['date'],
    'u1_union_all': ['date'],
    'u2_union_missing': ['date'],
    'u3_date_difference': ['date'],
    'u4_date_intersection': ['date'],
    'w1_shift_days': ['date'],
    'w1_shift_rows': ['date'],
    'w2_delta': ['date'],
    'w4_ffill': ['date'],
    'w5_quantile_map': ['date'],
}
