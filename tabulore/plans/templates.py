"""Fixed texts of the generated questions, answers, passages and prompts.

Fixed values: each entry must read exactly as given, because the generated
pairs are compared as text. ``{name}`` marks a place filled per row. Entries of
``TABLE_QA`` and ``REGISTRY_QA`` are (category, instruction, response);
``CLAUSES`` holds the parts that only appear under a condition.
"""

TABLE_QA = {
    "row_measurements": (
        "row_level",
        "What are the measurements for {id_name} {row_id} in the {readable} data?",
        "For {id_name} {row_id} in the {table} table: Measurements: {measurements}.{properties}",
    ),
    "row_cell": (
        "row_level",
        "What is the {name} for {id_name} {row_id} in {readable}?",
        "The {name} for {id_name} {row_id} in the {table} table is {value}.",
    ),
    "value_range": (
        "aggregation",
        "What is the range of {name} values in {readable}?",
        "The {name} values in {table} range from {min} to {max}, with a mean of {avg}{stddev}. "
        "There are {n} non-null measurements.",
    ),
    "most_common": (
        "aggregation",
        "What are the most common {name} values in {readable}?",
        "The most common {name} values in the {table} table are: {values}. "
        "The table contains {n_rows} total records.",
    ),
    "distinct_values": (
        "aggregation",
        "How many distinct {name} values exist in {readable}?",
        "There are at least {n_values} distinct {name} values in the {table} table. "
        "The most frequent is '{top_value}' with {top_n} records.",
    ),
    "compare_groups": (
        "comparison",
        "How does {num_name} compare across different {cat_name} values in {readable}?",
        "Comparing {num_name} by {cat_name} in the {table} table: {parts}.",
    ),
    "tables_available": (
        "schema",
        "What tables are available in the {schema} schema?",
        "The {full_schema} schema contains {n_tables} tables: {tables}.",
    ),
    "data_volume": (
        "schema",
        "How much data is in the {schema} schema?",
        "The {schema} schema contains {n_tables} tables with a total of {n_rows} records "
        "and {n_cols} columns across all tables.",
    ),
    "shared_columns": (
        "schema",
        "Which columns are shared across multiple tables in {schema}?",
        "Several columns appear in multiple tables, indicating relationships: {shared}. "
        "These shared columns can be used to join data across tables.",
    ),
    "table_relations": (
        "schema",
        "How are the tables in {schema} related to each other?",
        "The tables in {schema} are related through shared columns: {shared}. "
        "These common fields allow you to link records across tables for cross-table analysis.",
    ),
    "variability": (
        "reasoning",
        "Which measurements show the most variability in {readable}?",
        "In the {table} table, {name} shows high variability with a coefficient of variation of {cv}. "
        "Values range from {min} to {max} with a mean of {avg} and standard deviation of {stddev}. "
        "This suggests significant variation in experimental conditions or sample properties.",
    ),
    "quality": (
        "reasoning",
        "What can you tell me about the data quality of {readable}?",
        "The {table} table has {n_rows} records across {n_cols} columns. "
        "It contains {n_numeric} numeric measurement columns and {n_categorical} categorical columns. "
        "{most_variable}Review null counts and outlier distributions for a complete quality assessment.",
    ),
    "class_balance": (
        "reasoning",
        "Is the {readable} data balanced across {cat_name} categories?",
        "The {table} data shows imbalance across {cat_name}: the most common value '{top_value}' has {top_n} records, "
        "while '{bottom_value}' has only {bottom_n}. "
        "This imbalance should be considered when building predictive models, "
        "as underrepresented categories may have less reliable statistics.",
    ),
    "missing_values": (
        "data_quality",
        "Are there any missing values in the {readable} data?",
        "Yes, the {table} table has missing values in {n_columns} columns: {columns}. "
        "The table has {n_rows} total records.",
    ),
    "no_missing_values": (
        "data_quality",
        "Are there any missing values in the {readable} data?",
        "No, the {table} table has no missing values across all {n_cols} columns and {n_rows} records.",
    ),
    "outliers": (
        "data_quality",
        "Are there outliers in {name} in {readable}?",
        "Using the IQR method (1.5x interquartile range), there are {n_outlier} potential outliers in {name} "
        "in the {table} table. Q1={q1}, Q3={q3}, IQR={iqr}. "
        "Values below {lower} or above {upper} are flagged. This represents {pct}% of {n_rows} records.",
    ),
    "no_outliers": (
        "data_quality",
        "Are there outliers in {name} in {readable}?",
        "Using the IQR method, no outliers were detected in {name} in the {table} table. "
        "All {n_rows} values fall within the expected range ({lower} to {upper}).",
    ),
    "sanity_checks": (
        "data_quality",
        "What sanity checks should I run on the {readable} data before analysis?",
        "For the {table} table ({n_rows} records), key checks include: {checks}. "
        "Also verify that numeric ranges are physically plausible and that no duplicate records exist.",
    ),
    "precision": (
        "uncertainty",
        "How precise are the {name} measurements in {readable}?",
        "The {name} measurements in {table} have {precision} precision with a coefficient of variation (CV) of "
        "{cv} ({cv_pct}%). Mean: {avg}, standard deviation: {stddev}, based on {n} measurements.",
    ),
    "mean_interval": (
        "uncertainty",
        "What is the 95% confidence interval for the mean {name} in {readable}?",
        "The 95% confidence interval for the mean {name} in {table} is [{ci_lo}, {ci_hi}]. "
        "This is based on {n} measurements with mean {avg} and standard error {se}.",
    ),
    "completeness": (
        "reproducibility",
        "How complete is the metadata in the {readable} table?",
        "The {table} table has {pct}% column completeness. "
        "{n_complete} of {n_cols} columns have no missing values{gaps}.",
    ),
    "missing_metadata": (
        "reproducibility",
        "What metadata is missing from {readable} for reproducibility?",
        "For full reproducibility of the {table} data{present}{missing}. "
        "Consider adding calibration references and standard operating procedure versions if not tracked elsewhere.",
    ),
    "correlated": (
        "correlation",
        "Which variables are correlated in the {readable} data?",
        "In the {table} table, the following strong correlations were found: {pairs}. "
        "Strong correlations (|r| > 0.7) suggest these variables may be measuring related phenomena "
        "or one may be derivable from the other.",
    ),
    "independent": (
        "correlation",
        "Which variables are independent of each other in {readable}?",
        "In the {table} table, these variable pairs show weak or no correlation: {pairs}. "
        "These variables appear to measure independent aspects of the data.",
    ),
    "affects": (
        "correlation",
        "Does {a} affect {b} in {readable}?",
        "There is a {strength} {direction} correlation between {a} and {b} in the {table} table (r={r}). "
        "This means {meaning}. Note: correlation does not imply causation — this relationship may be "
        "driven by a confounding variable.",
    ),
    "redundant": (
        "correlation",
        "Are any measurements redundant in {readable}?",
        "The following pairs in {table} are very highly correlated (|r| > 0.95), "
        "suggesting they may be measuring the same thing: {pairs}. "
        "Consider whether both are needed or if one can be derived from the other.",
    ),
    "most_connected": (
        "correlation",
        "What is the most connected variable in {readable}?",
        "In the {table} table, {name} has the highest average correlation with other variables (mean |r|={mean_r}). "
        "It is most strongly correlated with: {partners}. "
        "This suggests {name} may be a key driver or central measurement.",
    ),
    "tables_related": (
        "cross_table",
        "How are {readable_a} and {readable_b} related?",
        "{table_a} and {table_b} share the column '{name}'. "
        "Of {n_a} distinct values in {table_a} and {n_b} in {table_b}, {n_overlap} values appear in both tables "
        "({pct}% overlap with the smaller set). "
        "These tables can be joined on '{name}' to combine their measurements.",
    ),
    "join_gain": (
        "cross_table",
        "What would I learn by joining {readable_a} and {readable_b}?",
        "Joining {table_a} and {table_b} on '{name}' would combine {gain_a}{joint}{gain_b}. "
        "This would give a more complete picture of each {name}, "
        "allowing analysis of how measurements in one table relate to the other.",
    ),
    "highest_group": (
        "subgroup",
        "Which {cat_name} category has the highest {num_name} in {readable}?",
        "In the {table} table, '{high_value}' has the highest average {num_name} at {high_avg} ({high_n} samples), "
        "while '{low_value}' has the lowest at {low_avg} ({low_n} samples). The difference is {diff} ({pct}%).",
    ),
    "groups_differ": (
        "subgroup",
        "Do different {cat_name} groups behave differently for {num_name} in {readable}?",
        "Yes, there is a notable difference in {num_name} across {cat_name} groups in the {table} table "
        "({pct}% spread). Breakdown: {groups}. "
        "This difference may indicate that {cat_name} is an important factor influencing {num_name}.",
    ),
    "multi_outliers": (
        "anomaly",
        "Which samples are unusual across multiple measurements in {readable}?",
        "The following samples in {table} are outliers in more than one measurement simultaneously: {samples}. "
        "Multi-measurement outliers may indicate genuinely unusual samples, measurement errors, "
        "or samples from a different population.",
    ),
    "bimodal": (
        "anomaly",
        "Is the {name} distribution unusual in {readable}?",
        "The {name} distribution in {table} may be bimodal — only {pct}% of values fall in the middle third "
        "of the range. There are {n_lower} values in the lower half and {n_upper} in the upper half. "
        "This pattern could indicate two distinct populations, different experimental conditions, "
        "or a phase transition in the measured phenomenon.",
    ),
    "surprising_group": (
        "anomaly",
        "Are there any surprising {num_name} values by {cat_name} in {readable}?",
        "Yes — the '{value}' group in {table} has {direction} {num_name} (mean {group_avg}) "
        "compared to the overall mean ({avg}). This is {z} standard deviations from the overall average. "
        "This may warrant further investigation.",
    ),
    "focus": (
        "interpretation",
        "What should I focus on when analyzing the {readable} data?",
        "Key observations for the {table} table: {highlights}.",
    ),
    "story": (
        "interpretation",
        "What story does the {readable} data tell?",
        "{parts}.",
    ),
    "relationships": (
        "interpretation",
        "What are the key relationships between variables in {readable}?",
        "The strongest relationships in the {table} table are: {pairs}. "
        "These correlations suggest which variables are linked and may "
        "help identify driving factors in the experimental results.",
    ),
    "sufficiency": (
        "interpretation",
        "Is there enough data in {readable} to draw reliable conclusions?",
        "The {table} table has {n_rows} records and {n_numeric} numeric measurements. {note}",
    ),
}

REGISTRY_QA = {
    "describe": ("model_info", "Describe the {model} model.", "{summary}"),
    "metrics": (
        "model_info",
        "What are the performance metrics for {label}?",
        "The performance metrics for {label} are: {metrics}. This model is currently in the {stage} stage.",
    ),
    "params": (
        "model_info",
        "What parameters were used to train {label}?",
        "The training parameters for {label} are: {params}.",
    ),
    "stage": (
        "model_info",
        "What stage is {model} in?",
        "{label} is currently in the {stage} stage.{description}",
    ),
    "one_metric": (
        "model_info",
        "What is the {metric} for {model}?",
        "The {metric} for {label} is {value}.",
    ),
    "ranking": (
        "model_comparison",
        "Compare all models on {metric}.",
        "Ranking models by {metric} ({direction} is best): {ranking}. "
        "The best performing model is {best} with {metric} of {best_value}.",
    ),
    "best_metric": (
        "model_comparison",
        "Which model has the best {metric}?",
        "{best} has the best {metric} at {best_value}. The next closest is {second} at {second_value}.",
    ),
    "pairwise": (
        "model_comparison",
        "Compare {model_a} and {model_b}.",
        "Comparing {label_a} vs {label_b}: {parts}. "
        "Overall, {overall} performs better across the majority of metrics.",
    ),
    "deploy": (
        "recommendation",
        "Which model should I deploy to production?",
        "Based on the metrics in MLflow, {label} performs best across {wins} of {n_metrics} tracked metrics. "
        "It leads in: {led}. It is currently in the {stage} stage.{description}",
    ),
    "best_model": (
        "recommendation",
        "What is your recommendation for the best model?",
        "I recommend {label} as it outperforms other models on {wins} out of {n_metrics} metrics. "
        "Key strengths: {led}.",
    ),
    "fastest": (
        "recommendation",
        "Which model is fastest for real-time inference?",
        "The fastest model is {label} with {metric} of {value}.{alternative}",
    ),
    "low_latency": (
        "recommendation",
        "I need low latency — which model should I use?",
        "For low latency requirements, {label} is the best choice with {metric} of {value}. "
        "It is currently in the {stage} stage.",
    ),
    "max_accuracy": (
        "recommendation",
        "Which model has the best {metric} for maximum accuracy?",
        "For maximum accuracy, {label} has the highest {metric} at {value}. It is in the {stage} stage.",
    ),
    "lowest_error": (
        "recommendation",
        "Which model has the lowest {metric}?",
        "The model with the lowest {metric} is {label} at {value}.",
    ),
    "in_production": (
        "deployment",
        "What models are currently in production?",
        "The following models are currently in the Production stage: {models}.",
    ),
    "production_metrics": (
        "deployment",
        "How is {model} performing in production?",
        "{label} is in Production with metrics: {metrics}.",
    ),
    "how_many": (
        "deployment",
        "How many models are registered in MLflow?",
        "There are {n_models} registered models in MLflow with {n_versions} total versions tracked. "
        "Stages: {stages}.",
    ),
    "list_models": (
        "deployment",
        "List all registered models.",
        "Registered models in MLflow: {models}.",
    ),
    "trade_off": (
        "trade_off",
        "What is the trade-off between {accuracy} and {latency} across models?",
        "There is a trade-off between {accuracy} and {latency}: {parts}. "
        "Higher accuracy models tend to have higher latency.",
    ),
    "history": (
        "trade_off",
        "How has {model} improved across versions?",
        "Version history for {model}: {parts}.",
    ),
    "risk": (
        "trade_off",
        "What are the risks of keeping {model} in production?",
        "Risks for {label} in Production: it has the worst {metric} ({value}) among all models. "
        "Consider evaluating alternatives and running A/B tests before making changes.",
    ),
    "metrics_tracked": (
        "registry_overview",
        "What metrics are tracked across our models?",
        "The following metrics are tracked in MLflow across {n_versions} model versions: {metrics}. "
        "Not all models have every metric — coverage varies by model.",
    ),
    "params_tracked": (
        "registry_overview",
        "What training parameters are tracked?",
        "The following training parameters are logged in MLflow: {params}.",
    ),
    "summary": (
        "registry_overview",
        "Give me a summary of our MLflow model registry.",
        "The MLflow registry contains {n_models} registered models with {n_versions} tracked versions. {stages}. "
        "We track {n_metrics} unique metrics and {n_params} unique parameters across all models.",
    ),
    "comparable": (
        "registry_overview",
        "Which models can be directly compared?",
        "Models sharing the same metrics can be compared directly. Shared metrics: {shared}.",
    ),
    "reliability": (
        "scientific_reliability",
        "How reliable is {model} for making scientific decisions?",
        "{label} has the following error metrics: {metrics}. "
        "When using this model for scientific decisions, these error values represent "
        "the expected uncertainty in predictions. Results within this error margin "
        "should not be treated as meaningfully different.",
    ),
    "confidence": (
        "scientific_reliability",
        "How confident should I be in {model}'s predictions?",
        "{label} achieves {metrics}. "
        "This means the model correctly captures the underlying patterns in the data "
        "at this level of accuracy. For high-stakes scientific conclusions, "
        "consider cross-validating with independent datasets or experimental replication.",
    ),
    "variability": (
        "scientific_reliability",
        "Which model best handles variability in experimental measurements based on {metric}?",
        "{best} has the lowest {metric} at {best_value}, "
        "meaning it produces predictions closest to the actual measured values. "
        "In contrast, {worst} has {metric} of {worst_value}. "
        "For experiments with high measurement noise, the lower-error model will give "
        "more trustworthy predictions.",
    ),
    "reproduce": (
        "scientific_reproducibility",
        "Can I reproduce the results of {model}?",
        "To reproduce {label}, the following training parameters are logged: {params}. {seed}"
        "For full reproducibility, ensure the same training data, software versions, "
        "and hardware configuration are used.",
    ),
    "continuous": (
        "scientific_fitness",
        "Which model should I use for predicting continuous experimental measurements?",
        "For predicting continuous values (e.g., concentrations, yields, physical properties), "
        "choose the model with the lowest error metrics. {models}. "
        "Lower error means the model's predictions will be closer to actual experimental values.",
    ),
    "classification": (
        "scientific_fitness",
        "Which model should I use for classifying experimental outcomes?",
        "For classification tasks (e.g., pass/fail, sample type, anomaly detection), "
        "choose the model with the highest accuracy-type metrics. {models}. "
        "Higher accuracy means fewer misclassifications in your experimental analysis.",
    ),
    "limitations": (
        "scientific_reliability",
        "What are the scientific limitations of {model}?",
        "Limitations of {label}: {limits}. "
        "These limitations should be considered when interpreting model predictions "
        "for scientific decision-making.",
    ),
    "choose": (
        "scientific_fitness",
        "How should I choose between models for my experiment?",
        "Model selection depends on your experimental goals. "
        "We have {n_versions} model versions tracking {n_metrics} metrics. "
        "For the most accurate predictions, choose the model that performs best on "
        "the metric most relevant to your experiment. {best}. "
        "Always validate model predictions against held-out experimental data "
        "before relying on them for scientific conclusions.",
    ),
    "trust": (
        "scientific_reliability",
        "Can I trust these models for scientific analysis?",
        "The {n_versions} models in our registry have been evaluated on {n_metrics} metrics. "
        "Models should be trusted within the bounds of their measured performance — "
        "extrapolating beyond the training data distribution is risky. "
        "Best practices: validate on independent experimental data, "
        "compare predictions to known physical/chemical constraints, "
        "and report model uncertainty alongside predictions.",
    ),
}

CLAUSES = {
    "row_properties": " Properties: {properties}.",
    "measurement": "{name} of {value}",
    "property": "{name} is {value}",
    "range_stddev": " and standard deviation of {stddev}",
    "value_count": "{value} ({n} records)",
    "group_average": "{value} has an average {num_name} of {avg} ({n} samples)",
    "table_size": "{readable} ({n_rows} rows)",
    "shared_column": "'{name}' appears in {tables}",
    "most_variable": "The most variable measurement is {name} (CV={cv}), which may warrant further investigation. ",
    "null_column": "{name} has {n} nulls ({pct}%)",
    "check_nulls": "check {name} for missing values ({n} nulls, {pct}%)",
    "check_constant": "investigate {name} — all values are identical ({value})",
    "check_dominant": "review {name} — value '{value}' dominates at {pct}% of records",
    "gaps": ". Columns with gaps: {columns}",
    "gap": "{name} ({pct}% complete)",
    "no_gaps": ". All columns are fully populated",
    "metadata_present": ", the following metadata is present: {present}",
    "metadata_missing": ". Missing metadata that would improve reproducibility: {missing}",
    "metadata_all": ". All key reproducibility metadata appears to be present",
    "strong_positive": "{a} and {b} are strongly positively correlated (r={r})",
    "strong_negative": "{a} and {b} are strongly negatively correlated (r={r})",
    "pair": "{a} and {b} (r={r})",
    "meaning_up": "as {a} increases, {b} tends to increase",
    "meaning_down": "as {a} increases, {b} tends to decrease",
    "partner": "{name} (r={r})",
    "gain_a": "measurements from {table} ({columns}) ",
    "gain_b": "measurements from {table} ({columns})",
    "group_detail": "'{value}': mean {avg}, std {stddev}, n={n}",
    "multi_outlier": "{id} (outlier in {n} measurements)",
    "focus_cv": "{name} has the highest variability (CV={cv}), "
    "making it the most informative measurement for distinguishing samples",
    "focus_pair": "{a} and {b} are strongly correlated (r={r}), suggesting a relationship worth investigating",
    "focus_few": "with only {n_rows} records, statistical conclusions should be treated with caution",
    "focus_many": "with {n_rows} records, there is sufficient data for robust statistical analysis",
    "story_size": "The {table} table contains {n_rows} records with {n_numeric} measurements",
    "story_stable": "Measurements like {columns} are very consistent across samples (low variability)",
    "story_variable": "Measurements like {columns} show wide variation, "
    "suggesting they are sensitive to experimental conditions or sample differences",
    "story_strong": "There are {n} strongly correlated variable pairs, "
    "indicating underlying physical or chemical relationships",
    "related_pair": "{a} and {b} are {direction} correlated (r={r})",
    "underpowered": "Warning: with only {ratio} samples per variable, the dataset may be underpowered "
    "for multivariate analysis. Consider collecting more data or reducing the number of variables.",
    "adequate": "The sample-to-variable ratio is {ratio}:1, which is adequate for basic analysis "
    "but may be insufficient for complex modeling. Simple correlations and t-tests are reliable, "
    "but multivariate models should be validated carefully.",
    "well_powered": "With {ratio} samples per variable, the dataset is well-powered for statistical analysis "
    "including multivariate methods.",
    "label": "{model} (v{version})",
    "ranked": "{model} v{version}: {value}",
    "best_label": "{model} v{version}",
    "summary_head": "{label}, stage: {stage}",
    "summary_description": "Description: {description}",
    "summary_metrics": "Metrics: {metrics}",
    "summary_params": "Parameters: {params}",
    "stage_description": " Description: {description}.",
    "pair_metric": "{metric}: {label_a} = {value_a}, {label_b} = {value_b}",
    "more_accurate": " However, if accuracy is more important, {label} may be preferred despite higher latency.",
    "list_entry": "{model} v{version} ({stage})",
    "trade_off_entry": "{label}: {accuracy}={accuracy_value}, {latency}={latency_value}",
    "history_entry": "v{version} ({stage}): {metrics}",
    "comparable_entry": "{metric}: {labels}",
    "seed_logged": "A random seed is recorded, which is essential for exact reproducibility. ",
    "seed_missing": "No random seed is recorded — results may vary between training runs. ",
    "limit_variance": "{metric} is {value}, meaning the model explains less than {pct}% of the variance in the data",
    "limit_misses": "{metric} is {value}, indicating the model may miss or misclassify "
    "a significant portion of samples",
    "limit_params": "only {n} training parameters are logged, "
    "which may make it difficult to reproduce or understand this model",
    "best_entry": "Best {metric}: {label} ({value})",
}

# Kinds of recording metadata a table may hold, by hints in column
# names, with the wording used when the kind is missing and when it is present.
METADATA_KINDS = (
    ("date", ("date", "time"), "timestamp or date of measurement", "timestamps"),
    ("operator", ("operator", "user", "analyst"), "operator or analyst identifier", "operator info"),
    ("batch", ("batch", "run", "lot"), "batch or run identifier", "batch identifiers"),
    ("instrument", ("instrument", "device", "equipment"), "instrument or device identifier", "instrument info"),
    ("unit", ("unit",), "units column or unit metadata", None),
)

# Texts of training passages and overviews.
PASSAGES = {
    "table_overview": "Table: {table}\n"
    "Description: {readable} — This table contains {n_rows} records with {n_cols} fields.\n"
    "Columns: {columns}.\n"
    "Numeric measurements: {numeric}.\n"
    "Categorical/text fields: {text}.\n",
    "schema_overview": "Data Schema Overview: {full_schema}\n\n"
    "This schema contains {n_tables} tables with a total of {n_rows} records of scientific data.\n"
    "The data supports data-driven decision making for scientific analysis and model evaluation.\n\n"
    "Tables in this schema:\n{tables}{shared}",
    "schema_table": "- {readable} ({table}): {n_rows} records, {n_cols} fields\n",
    "schema_shared_head": "\nShared columns across tables (potential relationships):\n",
    "schema_shared": "- '{column}' appears in: {tables}\n",
    "record": "Record from {readable} ({table}):",
    "identification": "Identification — {fields}.",
    "measurements": "Measurements — {fields}.",
    "properties": "Properties — {fields}.",
    "field": "{name}: {value}",
    "passage": "Data from {readable} ({table}):\n\n{rows}\n\n"
    "The above records are from the {name} dataset containing {n_rows} total records "
    "with {n_cols} measured properties.",
}

# Prompt texts.
PROMPTS = {
    "model_head": "### Model {index}: {model} (v{version})",
    "model_stage": "Stage: {stage}",
    "model_description": "Description: {description}",
    "model_metrics": "Metrics:",
    "model_params": "Parameters:",
    "model_entry": "  - {key}: {value}",
    "recommendation": "You are an expert ML engineer helping select the best model for deployment.\n\n"
    "## Task\n{task}\n\n"
    "## Available Models\n{models}\n\n"
    "## Your Analysis\n"
    "Please evaluate these models and provide:\n"
    "1. **Recommendation**: Which model should be selected for production\n"
    "2. **Justification**: Why this model is the best choice (reference specific metrics)\n"
    "3. **Acceptance Criteria**: What criteria this model meets\n"
    "4. **Risks/Considerations**: Any concerns or monitoring recommendations\n"
    "{criteria}\n## Response\n",
    "criteria": "\n## Additional Criteria to Consider\n{criteria}\n",
    "instruct": "<s>[INST] {instruction} [/INST] {response}</s>",
    "chat_start": "<s>",
    "chat_user": "[INST] {text} [/INST] ",
    "chat_assistant": "{text}</s><s>",
    "instruction_end": "[/INST]",
}
