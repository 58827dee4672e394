"""Labels, thresholds and word lists that results must carry unchanged."""

# --- fixed values: scoring ---------------------------------------------------------
SIGNAL_WEIGHTS = {"flag_IQR": 1, "flag_ZScore": 1, "flag_IsoForest": 2, "flag_HDBSCAN": 2}
METHOD_FLAGS = ("flag_IQR", "flag_ZScore", "flag_IsoForest", "flag_HDBSCAN")
HIGH_RISK_SCORE = 3
CRITICAL_RISK_SCORE = 5
BASELINE_FRAUD_RATE = 0.0012883

REASONS = (
    ("flag_IQR", "High amount anomaly by IQR"),
    ("flag_ZScore", "Extreme amount anomaly by Z-Score"),
    ("flag_IsoForest", "Multivariate anomaly by Isolation Forest"),
    ("flag_HDBSCAN", "Cluster outlier from BIRCH+HDBSCAN"),
    ("flag_BalanceMismatch", "Extreme balance mismatch in origError/destError"),
    ("origDrainedToZero", "Origin account drained to zero"),
)
NO_REASON = "No anomaly detected"

SERVING_REASONS = (
    ("flag_IQR", "Nominal tinggi tak wajar (IQR)"),
    ("flag_ZScore", "Nominal ekstrem (Z-Score)"),
    ("flag_IsoForest", "Kombinasi perilaku tak wajar (Isolation Forest)"),
    ("flag_HDBSCAN", "Menyimpang dari struktur klaster (BIRCH+HDBSCAN)"),
    ("flag_BalanceMismatch", "Ketidaksesuaian saldo asal/tujuan"),
)
NO_SERVING_REASON = "Tidak ada indikator yang terpicu"

# --- fixed values: serving labels --------------------------------------------------
TRUE_ENCODINGS = ("true", "1", "1.0", "m", "merchant", "yes", "y")
DEST_MERCHANT = "Merchant"
DEST_CUSTOMER = "Nasabah"
DRAINED = "Terkuras Habis"
NOT_DRAINED = "Tidak Terkuras"
CRITICAL_LABEL = "Kritis"

RISK_LEVELS = ("Normal", "Low", "Medium", "High", "Critical")
RISK_LEVEL_LABELS = {"Normal": "Normal", "Low": "Rendah", "Medium": "Sedang", "High": "Tinggi", "Critical": "Kritis"}
ANOMALY_TYPE_LABELS = {
    "No Statistical Anomaly": "Tidak Ada Anomali Statistik",
    "Balance Mismatch": "Ketidaksesuaian Saldo",
    "Extreme Transaction Amount": "Nominal Transaksi Ekstrem",
    "Multiple Indicators": "Banyak Indikator Sekaligus",
    "Cluster Outlier": "Klaster Menyimpang (Outlier)",
    "Behavioral Outlier": "Perilaku Menyimpang (Outlier)",
    "Behavioral and Cluster Outlier": "Perilaku & Struktur Klaster Menyimpang",
}
INVESTIGATION_LABELS = {
    "Normal / Low Concern": "Normal / Perlu Perhatian Rendah",
    "Possible Data Quality Issue": "Kemungkinan Masalah Kualitas Data",
    "Potential Risk / Monitor": "Berpotensi Perlu Dipantau",
    "Potential Fraud": "Berpotensi Fraud",
    "Rare Legitimate Transaction": "Transaksi Sah yang Jarang Terjadi",
}
TRANSACTION_TYPE_LABELS = {
    "CASH_IN": "Setor Tunai",
    "CASH_OUT": "Tarik Tunai",
    "DEBIT": "Debit",
    "PAYMENT": "Pembayaran",
    "TRANSFER": "Transfer",
}
SEGMENT_NAMES = {
    0: "Tarik Tunai Volume Besar",
    1: "Pembayaran Merchant (Risiko Tertinggi)",
    2: "Transaksi Campuran",
    3: "Setor Tunai Bersaldo Tinggi",
    4: "Pembayaran Merchant Nominal Kecil",
}
METHOD_LABELS = {
    "flag_IQR": "IQR",
    "flag_ZScore": "Z-Score",
    "flag_IsoForest": "Isolation Forest",
    "flag_HDBSCAN": "BIRCH+HDBSCAN",
}
FUNNEL_STAGES = ("Seluruh transaksi", "Antrean high-risk", "Fraud di antrean high-risk")

# --- fixed values: search words that stand for a detection method -------------------
SEARCH_KEYWORDS = {
    "iqr": "flag_IQR",
    "z-score": "flag_ZScore",
    "zscore": "flag_ZScore",
    "z score": "flag_ZScore",
    "isolation forest": "flag_IsoForest",
    "isolation": "flag_IsoForest",
    "hdbscan": "flag_HDBSCAN",
    "birch": "flag_HDBSCAN",
    "klaster": "flag_HDBSCAN",
    "cluster": "flag_HDBSCAN",
    "saldo": "flag_BalanceMismatch",
    "balance": "flag_BalanceMismatch",
}

# --- fixed values: cube dimensions --------------------------------------------------
CUBE_COLUMNS = (
    "jenis_tujuan",
    "status_kuras",
    "transaction_type",
    "cluster_kmeans",
    "isFraud",
    "flag_IQR",
    "flag_ZScore",
    "flag_IsoForest",
    "flag_HDBSCAN",
    "flag_BalanceMismatch",
    "risk_score",
    "risk_level",
    "anomaly_type",
    "investigation_category",
    "high_risk",
)

# --- fixed values: association rules ------------------------------------------------
BINNED_COLUMNS = ("amount", "oldbalanceOrg", "oldbalanceDest", "origError", "destError")
BIN_LABELS = {
    1: ("all",),
    2: ("low", "high"),
    3: ("low", "medium", "high"),
    4: ("very_low", "low", "high", "very_high"),
    5: ("very_low", "low", "medium", "high", "very_high"),
}
TRIVIAL_CONSEQUENTS = ("isFraud_no", "hdbscan_normal", "orig_drained_no", "dest_merchant_no")
TRIVIAL_ANTECEDENTS = ("isFraud_no", "hdbscan_normal", "orig_drained_no")
USEFUL_CONSEQUENTS = (
    "isFraud_yes",
    "hdbscan_outlier",
    "cluster_kmeans",
    "very_high",
    "very_low",
    "orig_drained_yes",
    "dest_merchant_yes",
)
IMPORTANT_ITEMS = (
    "isFraud_yes",
    "isFraud_no",
    "hdbscan_outlier",
    "hdbscan_normal",
    "orig_drained_yes",
    "orig_drained_no",
    "dest_merchant_yes",
    "dest_merchant_no",
)
GROUP_FRAUD = "Pola Fraud"
GROUP_SEGMENT = "Pola Segmen"
GROUP_OUTLIER = "Pola Outlier"
GROUP_GENERAL = "Perilaku Umum"
RULE_GROUPS = (GROUP_FRAUD, GROUP_SEGMENT, GROUP_OUTLIER, GROUP_GENERAL)
MAIN_INSIGHT = "Insight utama"
EXTRA_INSIGHT = "Insight tambahan"
LIFT_TIERS = (
    "Sangat kuat\n(lift ≥ 100)",
    "Kuat\n(lift 10-100)",
    "Sedang\n(lift 2-10)",
    "Lemah\n(lift < 2)",
)
RULE_FILES_TOP10 = ("top_10_final_rules.csv", "top_rules_business.csv")
RULE_FILES_POOL = ("report_worthy_rules.csv", "fraud_focused_rules.csv", "meaningful_rules.csv")

# antecedents, consequents, support, confidence, lift
PINNED_RULES = (
    ("origError_very_low, orig_drained_yes", "isFraud_yes", 0.001259, 1.000000, 776.211297),
    ("cluster_kmeans_2, orig_drained_yes", "isFraud_yes", 0.000154, 1.000000, 776.211297),
    ("hdbscan_outlier, origError_very_low", "isFraud_yes", 0.000103, 0.904432, 702.030439),
    ("cluster_kmeans_2, origError_very_low", "isFraud_yes", 0.000161, 0.649746, 504.340335),
    ("type_DEBIT", "amount_very_low, cluster_kmeans_1", 0.005904, 0.906618, 4.597684),
    ("destError_low", "amount_very_low, cluster_kmeans_1", 0.176434, 0.882169, 4.473699),
    ("type_DEBIT", "amount_very_low, destError_very_low", 0.005420, 0.832352, 47.200336),
    ("cluster_kmeans_3", "oldbalanceOrg_very_high, type_CASH_IN", 0.014070, 0.998405, 7.325951),
    ("cluster_kmeans_2", "oldbalanceOrg_very_high, type_CASH_IN", 0.061243, 0.995951, 7.307946),
    ("cluster_kmeans_2", "destError_very_high, oldbalanceOrg_very_high", 0.048769, 0.793104, 7.197255),
)

TAKEAWAYS = {
    "fraud_certain": "Pola langka, tapi begitu muncul sangat terkonsentrasi ke fraud terkonfirmasi.",
    "fraud_possible": "Pola ini menaikkan konsentrasi fraud namun masih perlu konfirmasi lebih lanjut.",
    "segment": "Pola ini menjelaskan perilaku yang secara alami melekat pada satu segmen nasabah/transaksi.",
    "outlier": "Pola ini mengarah ke transaksi yang berada di luar struktur normal populasi.",
    "strong": "Pola perilaku yang kuat, berguna untuk menjelaskan bagaimana atribut transaksi bergerak bersama.",
    "general": "Pola bisnis umum yang membantu menjelaskan perilaku transaksi yang sering terjadi.",
}
RULE_ADVICE = {
    "fraud": "Jadikan kombinasi ini sebagai aturan pemblokiran/review otomatis pada sistem monitoring "
    "transaksi real-time, bukan sekadar laporan pasif. Prioritaskan tim investigasi fraud untuk "
    "transaksi yang cocok pola ini sebelum dana keluar dari sistem.",
    "segment": "Pakai pola ini untuk menyusun kebijakan khusus per segmen (mis. limit transaksi atau ambang "
    "verifikasi berbeda), bukan kebijakan seragam untuk semua nasabah.",
    "outlier": "Gunakan sebagai sinyal tambahan (bukan tunggal) untuk memicu peninjauan manual.",
    "strong": "Manfaatkan sebagai fitur tambahan pada aturan bisnis atau model deteksi berikutnya.",
    "general": "Cocok sebagai konteks/latar belakang, bukan prioritas tindakan investigasi.",
}

ITEM_LABELS = {
    "isFraud_yes": "berstatus fraud terkonfirmasi",
    "isFraud_no": "tidak berlabel fraud",
    "hdbscan_outlier": "outlier klaster (struktural)",
    "hdbscan_normal": "posisi klaster normal",
    "orig_drained_yes": "saldo pengirim terkuras hingga nol",
    "orig_drained_no": "saldo pengirim tidak terkuras hingga nol",
    "dest_merchant_yes": "tujuan berupa akun merchant",
    "dest_merchant_no": "tujuan berupa akun nasabah",
    "type_CASH_IN": "transaksi setor tunai",
    "type_CASH_OUT": "transaksi tarik tunai",
    "type_DEBIT": "transaksi debit",
    "type_PAYMENT": "transaksi pembayaran",
    "type_TRANSFER": "transaksi transfer",
    **{f"cluster_kmeans_{i}": f"Segmen {i}: {name}" for i, name in SEGMENT_NAMES.items()},
    "amount_very_low": "nominal transaksi sangat rendah",
    "amount_low": "nominal transaksi rendah",
    "amount_medium": "nominal transaksi sedang",
    "amount_high": "nominal transaksi tinggi",
    "amount_very_high": "nominal transaksi sangat tinggi",
    "oldbalanceOrg_very_low": "saldo awal pengirim sangat rendah",
    "oldbalanceOrg_low": "saldo awal pengirim rendah",
    "oldbalanceOrg_medium": "saldo awal pengirim sedang",
    "oldbalanceOrg_high": "saldo awal pengirim tinggi",
    "oldbalanceOrg_very_high": "saldo awal pengirim sangat tinggi",
    "oldbalanceDest_very_low": "saldo awal penerima sangat rendah",
    "oldbalanceDest_low": "saldo awal penerima rendah",
    "oldbalanceDest_medium": "saldo awal penerima sedang",
    "oldbalanceDest_high": "saldo awal penerima tinggi",
    "oldbalanceDest_very_high": "saldo awal penerima sangat tinggi",
    "origError_very_low": "ketidaksesuaian saldo pengirim sangat rendah",
    "origError_low": "ketidaksesuaian saldo pengirim rendah",
    "origError_medium": "ketidaksesuaian saldo pengirim sedang",
    "origError_high": "ketidaksesuaian saldo pengirim tinggi",
    "origError_very_high": "ketidaksesuaian saldo pengirim sangat tinggi",
    "destError_very_low": "ketidaksesuaian saldo penerima sangat rendah",
    "destError_low": "ketidaksesuaian saldo penerima rendah",
    "destError_medium": "ketidaksesuaian saldo penerima sedang",
    "destError_high": "ketidaksesuaian saldo penerima tinggi",
    "destError_very_high": "ketidaksesuaian saldo penerima sangat tinggi",
}
# group key, group title, item prefixes
ITEM_GROUPS = (
    ("jenis-transaksi", "Jenis Transaksi", ("type_",)),
    ("segmen-atom", "Segmen", ("cluster_kmeans",)),
    ("nominal", "Nominal Transaksi", ("amount_",)),
    ("saldo-awal", "Saldo Awal", ("oldbalance",)),
    ("selisih-saldo", "Selisih Saldo", ("origError", "destError")),
    ("status-kuras-atom", "Status Kuras Saldo", ("orig_drained",)),
    ("tujuan-atom", "Jenis Tujuan", ("dest_merchant",)),
    ("outlier-atom", "Outlier Struktural", ("hdbscan",)),
    ("status-fraud", "Status Fraud", ("isFraud",)),
)

# --- fixed values: recommendations --------------------------------------------------
# id, priority, category, title, related segment, related anomaly type, related rule group
PRIORITIES = ("Tinggi", "Sedang", "Rendah")
RECOMMENDATIONS = (
    ("rec-seg0-queue", "Tinggi", "Segmentasi", "Buat antrean pemantauan khusus untuk transaksi bernilai eksepsional", 0, None, None),
    ("rec-hdbscan-escalate", "Tinggi", "Deteksi Anomali", "Jadikan penanda struktural (HDBSCAN) sebagai pemicu eskalasi otomatis", None, "Klaster Menyimpang (Outlier)", None),
    ("rec-fraud-rules-autoblock", "Tinggi", "Pola & Asosiasi", "Jadikan kombinasi pola fraud sebagai aturan pemblokiran/review otomatis", None, None, "Pola Fraud"),
    ("rec-medium-risk-review", "Tinggi", "Deteksi Anomali", "Tinjau ulang transaksi level 'Sedang', jangan hanya fokus ke 'Kritis'", None, None, None),
    ("rec-debit-monitor", "Sedang", "Pola & Asosiasi", "Tambahkan aturan pemantauan khusus untuk transaksi jenis Debit", None, None, "Perilaku Umum"),
    ("rec-liquidity-segments", "Sedang", "Segmentasi", "Pisahkan kebijakan segmen likuiditas dari kebijakan anti-fraud", 2, None, "Pola Segmen"),
    ("rec-balance-mismatch-dq", "Sedang", "Kualitas Data", "Telusuri akar penyebab 'Ketidaksesuaian Saldo' sebagai isu kualitas data", None, "Ketidaksesuaian Saldo", None),
    ("rec-rare-legit", "Rendah", "Kualitas Data", "Dokumentasikan pola 'Transaksi Sah yang Jarang Terjadi' sebagai pengecualian resmi", None, None, None),
    ("rec-rule-transfer-drain-chain", "Tinggi", "Pola & Asosiasi", "Pantau rangkaian TRANSFER lalu CASH_OUT yang menguras saldo", 1, None, "Pola Fraud"),
    ("rec-rule-outlier-confirm", "Tinggi", "Pola & Asosiasi", "Perlakukan pola berpenanda outlier struktural sebagai sinyal prioritas", None, None, "Pola Outlier"),
    ("rec-rule-payment-safe-whitelist", "Sedang", "Pola & Asosiasi", "Manfaatkan pola PAYMENT-ke-merchant yang bersih untuk mengurangi beban review", 4, None, "Pola Segmen"),
    ("rec-rule-refresh-cadence", "Sedang", "Pola & Asosiasi", "Segarkan aturan asosiasi secara berkala mengikuti perubahan perilaku", None, None, None),
    ("rec-combine-score-and-rules", "Tinggi", "Deteksi Anomali", "Gabungkan skor risiko dengan pencocokan pola untuk prioritas akhir", None, None, "Pola Fraud"),
    ("rec-focus-segment1-capacity", "Tinggi", "Segmentasi", "Alokasikan kapasitas investigasi terbesar ke Segmen 1", 1, None, None),
    ("rec-monitor-drift-metrics", "Rendah", "Kualitas Data", "Pantau pergeseran proporsi anomali sebagai indikator dini", None, None, None),
)

# --- fixed values: columns that are labels or metadata, never projection features ----
NON_FEATURE_COLUMNS = (
    "isFraud",
    "isFlaggedFraud",
    "step",
    "cluster_kmeans",
    "cluster_hdbscan",
    "cluster_birch",
    "cluster_birch_hdbscan",
    "is_birch_hdbscan_outlier",
    "risk_score",
    "risk_level",
    "anomaly_type",
    "investigation_category",
    "high_risk",
    "nameOrig",
    "nameDest",
    "jenis_tujuan",
)

# transaction search: rows counted at most, columns a page may be ordered by, columns of a page
COUNT_CAP = 50_001
SORTABLE = ("risk_score", "amount", "step", "transaction_type", "jenis_tujuan", "cluster_kmeans", "risk_level", "isFraud", "anomaly_type")
RESULT_COLUMNS = (
    "transaction_id", "step", "transaction_type", "amount", "jenis_tujuan", "status_kuras", "cluster_kmeans",
    "risk_score", "risk_level", "investigation_category", "anomaly_type", "anomaly_reason", "isFraud",
)
# final rules: words of the outcome, and how many rules of each sort
TOP_RULE_OUTCOMES = ("isFraud_yes", "hdbscan_outlier", "cluster_kmeans")
TOP_RULE_QUOTAS = {"fraud": 4, "hdbscan_outlier": 2, "cluster_kmeans": 2, "other": 5}
