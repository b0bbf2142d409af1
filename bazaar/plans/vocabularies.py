"""Bilingual report headers.

Fixed values: the Indonesian headers of the metric reports and the column each
stands for. English headers are not listed: the report's header style turns them
into the same names.
"""

from __future__ import annotations

LIVE_INDONESIAN = {
    "Creator ID": "creator_id",
    "Kreator": "creator",
    "Nama panggilan": "nickname",
    "Waktu Live": "launched_time",
    "Durasi": "duration",
    "Penghasilan (Rp)": "revenue",
    "Produk": "products",
    "Produk Terjual": "different_products_sold",
    "Pesanan Dibuat": "orders_created",
    "Pesanan Dibayar": "orders_paid",
    "Penjualan": "unit_sales",
    "Pembeli": "buyers",
    "Harga Rata-Rata (Rp)": "average_price",
    "CO Rate": "co_rate",
    "Penonton": "viewers",
    "Live Stream Dilihat": "views",
    "Rata-rata Penonton": "acu",
    "Penonton Tertinggi": "pcu",
    "Durasi Rata-rata": "avg_viewing_duration",
    "Komentar": "comments",
    "Live Dibagikan": "shares",
    "Likes": "likes",
    "Pengikut Baru": "new_followers",
    "Produk Dilihat": "product_impressions",
    "Klik Produk": "product_clicks",
    "CTR": "ctr",
}

OVERVIEW_V1_INDONESIAN = {
    "Waktu": "time",
    "Penghasilan (Rp)": "revenue",
    "Penghasilan dari Pusat Belanja": "shopping_center_revenue",
    "Penghasilan dari Shop Tab": "shopping_center_revenue",
    "Penayangan Produk": "product_views",
    "Jangkauan Produk": "product_reach",
    "Pembeli": "buyers",
    "Penjualan": "unit_sales",
    "Pesanan": "orders",
    "Pengembalian Uang (Rp)": "refunds",
    "Tingkat Konversi": "conversion_rate",
    "Pengunjung": "visitors",
    "Tingkat Ulasan Negatif": "negative_review_rate",
    "Tingkat Pengembalian karena Alasan Kualitas": "rate_of_returns_for_quality_reasons",
    "Tingkat Pengaduan": "complaint_rate",
    "Afiliasi (Rp)": "affiliate_revenue",
    "Toko (Rp)": "owned_media_revenue",
}

OVERVIEW_V2_INDONESIAN = {
    "Tanggal": "date",
    "GMV (Rp)": "gmv",
    "Pengembalian dana (Rp)": "refunds",
    "Produk terjual": "items_sold",
    "Pembeli": "buyers",
    "Tayangan halaman": "page_views",
    "Pengunjung": "visitors",
    "Persentase konversi": "conversion_rate",
    "Pesanan SKU": "sku_orders",
    "Pesanan": "orders",
}

PRODUCT_INDONESIAN = {
    "Nama": "product_name",
    "Penghasilan (Rp)": "revenue",
    "Pembeli": "buyers",
    "Penjualan Produk": "product_sales",
    "Pengembalian Uang (Rp)": "refunds",
    "Produk Dikembalikan": "product_refunds",
    "Pesanan": "orders",
    "Komisi (Rp)": "commission",
    "Penghasilan live streaming (Rp)": "livestream_revenue",
    "Pesanan live streaming": "livestream_orders",
    "Pembeli live streaming": "livestream_buyers",
    "Penjualan produk live streaming": "livestream_product_sales",
    "Penonton produk live streaming": "livestream_product_viewers",
    "Pengguna yang mengeklik produk live streaming": "users_clicking_livestream_products",
    "Refund live streaming (Rp)": "livestream_refunds",
    "Refund Produk live streaming": "livestream_refunded_units",
    "Impresi produk live streaming": "livestream_product_impressions",
    "Klik produk live streaming": "livestream_product_clicks",
    "CTR produk live streaming": "livestream_product_ctr",
    "Tingkat CO produk live streaming": "livestream_product_co_rate",
    "Penghasilan Video (Rp)": "video_revenue",
    "Pesanan Video": "video_orders",
    "Pembeli Video": "video_buyers",
    "Penjualan Produk Video": "video_product_sales",
    "Penonton Video Produk": "video_product_viewers",
    "Pengguna (Klik Video Produk)": "users_clicking_video_products",
    "Refund Video (Rp)": "video_refunds",
    "Refund Video Produk": "video_refunded_units",
    "Impresi Video Produk": "video_product_impressions",
    "Klik video produk": "video_product_clicks",
    "CTR video produk": "video_product_ctr",
    "CO Rate video produk": "video_product_co_rate",
}

SERVICE_INDONESIAN = {
    "Nama panggilan": "nickname",
    "Tanggal": "date",
    "Alokasi obrolan": "allocated_chats",
    "Obrolan yang ditanggapi agen CS": "human_response_required_chats",
    "Obrolan yang ditanggapi agen CS dalam 24 jam": "24h_human_agent_responded_chats",
    "Tingkat respons agen CS dalam waktu 24 jam": "24h_human_agent_response_rate",
    "Pesan yang terlambat ditanggapi": "lateresponded_chats",
    "Pesan yang tidak ditanggapi": "nonresponded_chats",
    "Tingkat kepuasan": "satisfaction_rate",
    "Rata-rata waktu respons pertama": "avg_first_response_time",
}

VIDEO_INDONESIAN = {
    "Nama Kreator": "creator_name",
    "Informasi Video": "video_info",
    "Waktu": "time",
    "Produk": "products",
    "Penghasilan Video (Rp)": "video_revenue",
    "Penjualan Video": "unit_sales",
    "Pesanan Video": "orders",
    "Pembeli": "buyers",
    "Pengembalian Uang video (Rp)": "refunds",
    "Refund produk": "product_refunds",
    "CO Rate": "co_rate",
    "Komentar": "comments",
    "Dibagikan": "shares",
    "Produk Dilihat": "product_impressions",
    "Klik Produk": "product_clicks",
    "Pengikut baru": "new_followers",
    "Klik Video ke LIVE": "vtol_clicks",
    "GPM (Rp)": "gpm",
    "Rasio Video ke LIVE": "vtol_rate",
    "Persentase Video yang Ditonton Hingga Selesai": "video_finish_rate",
    "CTOR": "co_rate",
}


MARKETPLACE_ORDERS = {
    "No. Pesanan": "order_number",
    "Status Pesanan": "order_status",
    "Alasan Pembatalan": "cancel_reason",
    "Status Pembatalan/ Pengembalian": "cancel_return_status",
    "No. Resi": "receipt_number",
    "Opsi Pengiriman": "shipping_option",
    "Antar ke counter/ pick-up": "seller_shipping_option",
    "Pesanan Harus Dikirimkan Sebelum (Menghindari keterlambatan)": "due_date_shipping_product",
    "Waktu Pengiriman Diatur": "arrange_delivery_time",
    "Waktu Pesanan Dibuat": "create_delivery_time",
    "Waktu Pembayaran Dilakukan": "conducted_delivery_time",
    "SKU Induk": "sku",
    "Nama Produk": "product_name",
    "Nomor Referensi SKU": "sku_reference_number",
    "Nama Variasi": "variation_name",
    "Harga Awal": "initiate_price",
    "Harga Setelah Diskon": "discount_incl_price",
    "Jumlah": "total_goods",
    "Total Harga Produk": "total_product_price",
    "Total Diskon": "total_discount",
    "Diskon Dari Penjual": "discount_from_seller",
    "Diskon Dari Shopee": "discount_from_shopee",
    "Berat Produk": "weight_product",
    "Jumlah Produk di Pesan": "total_order_product",
    "Total Berat": "total_weight",
    "Voucher Ditanggung Penjual": "voucher_from_seller",
    "Cashback Koin": "coin_cashback",
    "Voucher Ditanggung Shopee": "voucher_from_shopee",
    "Paket Diskon": "discount_package",
    "Paket Diskon (Diskon dari Shopee)": "discount_shopee_package",
    "Paket Diskon (Diskon dari Penjual)": "discount_seller_package",
    "Potongan Koin Shopee": "coin_discount_shopee",
    "Diskon Kartu Kredit": "discount_credit_card",
    "Ongkos Kirim Dibayar oleh Pembeli": "buyer_shipping_price",
    "Estimasi Potongan Biaya Pengiriman": "estimate_discount_shipping_price",
    "Ongkos Kirim Pengembalian Barang": "return_shipping_price",
    "Total Pembayaran": "total_price",
    "Perkiraan Ongkos Kirim": "estimate_shipping_price",
    "Catatan dari Pembeli": "note_from_seller",
    "Catatan": "note",
    "Username (Pembeli)": "buyer_username",
    "Nama Penerima": "buyer_name",
    "No. Telepon": "buyer_phone_number",
    "Alamat Pengiriman": "buyer_address",
    "Kota/Kabupaten": "buyer_city",
    "Provinsi": "buyer_province",
    "Waktu Pesanan Selesai": "complete_delivery_time",
}

# Headers of the sales report in its order (normalised).
SALES_HEADERS = (
    "nomor", "nomor_invoice", "tanggal_pembayaran", "status_terakhir", "tanggal_pesanan_selesai",
    "waktu_pesanan_selesai", "tanggal_pesanan_dibatalkan", "waktu_pesanan_dibatalkan", "nama_produk",
    "tipe_produk", "nomor_sku", "catatan_produk_pembeli", "catatan_produk_penjual", "jumlah_produk_dibeli",
    "harga_awal_idr", "harga_satuan_bundling_idr", "diskon_produk_idr", "harga_jual_idr",
    "jumlah_subsidi_tokopedia_idr", "nilai_kupon_toko_terpakai_idr", "jenis_kupon_toko_terpakai",
    "kode_kupon_toko_yang_digunakan", "biaya_pengiriman_tunai_idr", "biaya_asuransi_pengiriman_idr",
    "total_biaya_pengiriman_idr", "total_penjualan_idr", "nama_pembeli", "no_telp_pembeli", "nama_penerima",
    "no_telp_penerima", "alamat_pengiriman", "kota", "provinsi", "nama_kurir",
    "tipe_pengiriman_regular_same_day_etc", "no_resi__kode_booking", "tanggal_pengiriman_barang",
    "waktu_pengiriman_barang", "gudang_pengiriman", "nama_campaign", "nama_bundling",
    "tipe_bebas_ongkir_bebas_ongkir_bebas_ongkir_dt", "cod", "jumlah_produk_yang_dikurangkan",
    "total_pengurangan_idr",
)
